r"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line stays.

A line's *variants* are the line itself and the line without one of its words. Two lines within
one word edit share a variant: after a substitution both lose the same position, after an
insertion one line is a variant of the other. Variants are emitted as hashed keys, equal keys
meet, the earliest line of a key is verified on the words themselves, and a line goes when a
line before it is equal, or is within the bound (and both have ``min_near`` words).

What keeps it linear: equal lines are one row with its earliest place before anything else; of
lines that share a variant with the same lost position ANY two are one substitution apart, so
each meets only the key's earliest line, by a minimum that Spark combines map-side, and a key
with a third of all lines makes no pairs. Only lines that share their first or last half with
another line can be within the bound (the edit lies in the other half), so only those emit
variants; a line's variant hashes are made in one pass by running XORs over its words.

A near line goes also when the earlier line it repeats goes itself, so of a chain of edits the head
stays. Order is (doc_id, hash of the text, line number), null doc_id first. Words are runs of
characters outside ``\x20\x09-\x0D``. Equal lines count whatever their length; lines of fewer
than ``min_near`` words are never near ones, since one edit would be more than a tenth of them.
Cases: null text stays null and has no lines; lines without a word never go; lines that differ
in white space alone are near ones; rows that repeat doc_id and text are one document and keep
the same lines; a document may end up empty but stays; an empty table gives no rows; other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.quality import words_of
from ranklift.llm.storage import cut, release

PLACE = ("doc_id", "text_hash", "line_no")
HALVES = ("h0", "h1", "h2", "h3")


def _half_keys(words: Column, n: Column) -> list[Column]:
    """Hashes of the first and last h words, for the h a line and a partner within the bound
    both use: half the length of the shorter."""
    keys = []
    for h in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys += [F.xxhash64(F.lit("first"), h, F.slice(words, 1, h)), F.xxhash64(F.lit("last"), h, F.slice(words, n - h + 1, h))]
    return keys


def _same_place(left: str, right: str) -> Column:
    same = [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in PLACE]
    return same[0] & same[1] & same[2]


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line) of every line of every document."""
    text = F.col("text").cast("string")
    once = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("__lines"))
    return once.select("doc_id", "text_hash", F.posexplode("__lines").alias("line_no", "line"))


def _line_id() -> list[Column]:
    return [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("2"), "line").alias("k2")]


def _variants(words: DataFrame) -> DataFrame:
    """(place, n, pos, key): key of the line without word ``pos``."""
    rows = words.select(*PLACE, "n", F.posexplode("words").alias("pos", "word"))
    rows = rows.select(*PLACE, "n", "pos", F.xxhash64("word", "pos").alias("stay"), F.xxhash64("word", F.col("pos") - 1).alias("move"))
    by_line = Window.partitionBy(*PLACE).orderBy("pos")
    run, rest = by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow), by_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", F.bit_xor("stay").over(run).alias("stayed"), F.bit_xor("move").over(run).alias("moved"), F.bit_xor("move").over(rest).alias("all_moved"))
    key = F.col("stayed").bitwiseXOR(F.col("stay")).bitwiseXOR(F.col("all_moved")).bitwiseXOR(F.col("moved"))
    return rows.select(*PLACE, "n", "pos", key.alias("key"))


def _whole(words: Column) -> Column:
    """The same key of a whole line."""
    return F.aggregate(F.transform(words, lambda w, i: F.xxhash64(w, i)), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two arrays of words are one substitution, insertion or deletion apart."""
    n, m = F.size(a), F.size(b)
    low = F.least(n, m)
    differ = F.filter(F.sequence(F.lit(0), low), lambda i: (i == low) | (F.get(a, i) != F.get(b, i)))
    p = F.array_min(differ)
    tail = low - p - F.when(n == m, 1).otherwise(0)
    return (F.abs(n - m) <= 1) & ((tail <= 0) | (F.slice(a, n - tail + 1, F.greatest(tail, F.lit(0))) == F.slice(b, m - tail + 1, F.greatest(tail, F.lit(0)))))


def duplicate_lines(docs: DataFrame, min_near: int = 10, broadcast_bytes: int = 16 << 20, hot: int = 1000) -> DataFrame:
    """(doc_id, text_hash, line_no, kind, first): the lines that go, ``kind`` "exact" or
    "near", and the place of the earlier line each repeats. The list of lines whose words are
    read again is broadcast when its (counted) rows take up to ``broadcast_bytes``; the fewer than
    ``hot`` lines that make up more than 1/``hot`` of all each meet their copies by broadcast."""
    spark = docs.sparkSession
    split = lines(docs).select("*", *_line_id(), words_of(F.col("line")).alias("words"))
    n = F.size("words")
    keys = [F.when(n >= min_near, k).alias(h) for h, k in zip(HALVES, _half_keys(F.col("words"), n))]
    rows = cut(split.where(n > 0).select(*PLACE, "k1", "k2", n.alias("n"), *keys))
    unlike = rows.groupBy("k1", "k2").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("size"), F.min("n").alias("n"), *(F.min(h).alias(h) for h in HALVES))
    unlike = cut(unlike.select("k1", "k2", *(F.col(f"first.{c}").alias(c) for c in PLACE), "size", "n", *HALVES))
    release(spark)

    halves = unlike.where("n >= %d" % min_near).select("k1", "k2", F.explode(F.array_distinct(F.array(*HALVES))).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("times")).where("times > 1").select("half")
    near = halves.join(shared, "half", "left_semi").select("k1", "k2").distinct()
    near = cut(near.join(unlike.select("k1", "k2", *PLACE), ["k1", "k2"]).select("k1", "k2", *(F.col(c).alias(f"__{c}") for c in PLACE)))
    release(spark)
    # the words of those lines, read from where each stands first
    ship = F.broadcast if near.count() * 48 <= broadcast_bytes else (lambda df: df)
    texts = lines(docs).select("*", *_line_id()).join(ship(near), ["k1", "k2"]).where(_same_place("", "__"))
    words = cut(texts.select("k1", "k2", *PLACE, words_of(F.col("line")).alias("words")).withColumn("n", F.size("words")).dropDuplicates(["k1", "k2"]))
    release(spark)
    variants = cut(_variants(words))
    release(spark)

    me = F.struct(*PLACE)
    # substitutions: the same position lost, so all of a key are one edit apart
    same = variants.groupBy("key", "pos", "n").agg(F.min(me).alias("other"), F.count("*").alias("times")).where("times > 1").drop("times")
    subst = variants.join(same, ["key", "pos", "n"]).select(me.alias("line"), "other")
    # insertions: a line that is a variant of another
    whole = words.select(_whole(F.col("words")).alias("key"), (F.col("n") + 1).alias("n"), me.alias("short"))
    grown = variants.join(whole, ["key", "n"]).select(me.alias("long"), "short").distinct()
    shorter = grown.groupBy("short").agg(F.min("long").alias("other"))
    met = subst.union(grown).union(shorter).where("other < line").groupBy("line").agg(F.min("other").alias("other"))
    met = met.select(*(F.col(f"line.{c}").alias(f"l_{c}") for c in PLACE), *(F.col(f"other.{c}").alias(f"o_{c}") for c in PLACE))
    mine = words.select("k1", "k2", *PLACE, F.col("words").alias("mine"))
    theirs = words.select(*(F.col(c).alias(f"t_{c}") for c in PLACE), F.col("words").alias("theirs"))
    checked = met.join(mine, _same_place("l_", "")).join(theirs, _same_place("o_", "t_")).where(_within_one(F.col("mine"), F.col("theirs")))
    checked = checked.select("k1", "k2", F.struct(*(F.col(f"o_{c}").alias(c) for c in PLACE)).alias("near_first"))

    fate = unlike.join(checked, ["k1", "k2"], "left").where("size > 1 or near_first is not null").select("k1", "k2", me.alias("first"), "near_first", "size")
    share = rows.count() / hot
    few = F.broadcast(fate.where(F.col("size") > share).drop("size"))  # fewer than `hot` lines
    many = fate.where(F.col("size") <= share).drop("size")
    placed = rows.select(*PLACE, "k1", "k2")
    gone = placed.join(few, ["k1", "k2"]).unionByName(placed.join(few.select("k1", "k2"), ["k1", "k2"], "left_anti").join(many, ["k1", "k2"]))
    exact = ~F.col("first").eqNullSafe(me)
    gone = gone.where(F.col("near_first").isNotNull() | exact)
    return gone.select(*PLACE, F.when(exact, "exact").otherwise("near").alias("kind"), F.when(exact, F.col("first")).otherwise(F.col("near_first")).alias("first"))


def drop_duplicate_lines(docs: DataFrame, min_near: int = 10) -> DataFrame:
    """``docs`` with the duplicate lines taken out of ``text``."""
    gone = duplicate_lines(docs, min_near).groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.array_sort(F.collect_set("line_no")).alias("__gone"))  # at most a text's lines
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash")), "left")
    left = F.filter(F.split(F.col("text").cast("string"), "\n"), lambda x, i: ~F.array_contains("__gone", i))
    return joined.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))).drop("__doc", "__hash", "__gone")
