"""URL filtering against dated lists: validity intervals and an as-of join.

``intervals`` turns dated entries (list, kind, pattern, at, action) into half-open validity
intervals [since, until): per list and pattern the entries are put in time order, repeats of
the standing action change nothing, a removal closes what an addition opened, and at the same
second a removal follows an addition. ``evaluate`` expands a capture's URL into everything an
entry may name (its host and parent domains; host and path cut at every length that a prefix
entry has) and joins on equality of (kind, pattern) with the fetch time inside the interval. Equal
captures (same URL and second) are looked up once; the verdict is joined back to all rows.

The lists are never collected. A host with a third of all captures is one key of the equality
join, which Spark splits (both joins are its own exchanges); a pattern's entries are its
history, ordered in one window.

Domains and the hosts of prefixes are lower-cased, paths are not; a URL or prefix without a path has
the path ``/``; scheme, user, port, query and fragment do not count. A prefix covers every URL whose
host and path begin with it, also within a path's part (``host/pri`` covers ``/private``). Cases: entries
without list, kind, pattern, time or known action hold nothing; a null or unparsable URL, or a
null fetch time, matches nothing and stays with blocked = false; repeated captures are returned
each; empty tables give no matches; extra capture columns pass through, but those named ``lists``
or ``blocked`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, URL, 2)


def normal(kind: Column, pattern: Column) -> Column:
    """Domains in lower case; prefixes with their host in lower case and at least ``/`` as path."""
    host, path = F.lower(F.substring_index(pattern, "/", 1)), F.regexp_extract(pattern, "^[^/]*(.*)$", 1)
    return F.when(kind == "domain", F.lower(pattern)).otherwise(F.concat(host, F.when(path == "", F.lit("/")).otherwise(path)))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, since, until); ``until`` null: still valid."""
    known = entries.where("list is not null and kind in ('domain', 'prefix') and pattern is not null and at is not null and action in ('add', 'remove')")
    known = known.select("list", "kind", normal(F.col("kind"), F.col("pattern")).alias("pattern"), "at", "action").distinct()
    order = Window.partitionBy("list", "kind", "pattern").orderBy("at", "action")
    changes = known.withColumn("before", F.lag("action").over(order)).where("before is null and action = 'add' or before <> action")
    return changes.withColumn("until", F.lead("at").over(order)).where("action = 'add' and (until is null or until > at)").select("list", "kind", "pattern", F.col("at").alias("since"), "until")


def keys_of(url: Column, lengths: Column) -> Column:
    """array<struct<kind, pattern>> of what an entry may name to cover ``url``; ``lengths``: those
    of the prefix entries."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    whole = F.concat(host_of(url), F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url)))
    cuts = F.filter(lengths, lambda n: (n > F.length(host_of(url))) & (n <= F.length(whole)))
    prefixes = F.transform(cuts, lambda n: F.struct(F.lit("prefix").alias("kind"), F.substr(whole, F.lit(1), n).alias("pattern")))
    return F.when(host_of(url) != "", F.concat(domains, prefixes))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_at, ...) with ``blocked`` and ``lists``, the sorted names of
    the lists with an entry active at fetch time, joined by commas (empty: none)."""
    once = captures.where("url is not null and fetched_at is not null").select(F.col("url").alias("__url"), F.col("fetched_at").alias("__at")).distinct()
    valid = intervals(entries)
    found = valid.where("kind = 'prefix'").agg(F.sort_array(F.collect_set(F.length("pattern")))).first()[0]  # no more than a URL's length
    lengths = F.array(*(F.lit(n) for n in found)).cast("array<int>")
    keyed = once.select("__url", "__at", F.explode(keys_of(F.col("__url"), lengths)).alias("k")).select("__url", "__at", "k.kind", "k.pattern")
    active = keyed.join(valid, ["kind", "pattern"]).where("since <= __at and (until is null or __at < until)")
    verdict = active.groupBy("__url", "__at").agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("__lists"))
    joined = captures.join(verdict, (F.col("url") == F.col("__url")) & (F.col("fetched_at") == F.col("__at")), "left")
    return joined.withColumn("lists", F.coalesce("__lists", F.lit(""))).withColumn("blocked", F.col("__lists").isNotNull()).drop("__url", "__at", "__lists")
