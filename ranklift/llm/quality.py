"""Quality rules with thresholds learnt per language and source from mergeable sketches.

Per text, native column expressions give the measures; ``sketch`` counts their values per
(lang, source) in logarithmic bins of 1/32 relative width. Counts add up, so sketches merge
exactly, in any order and over any partitioning, and every quantile read from them is the
lower edge of the bin that holds it: the same on each run and in SQL.

A text is rejected when it fails a base rule, or when one of its measures lies far outside its
group: above ``q3 + spread * (q3 - q1)`` or, for lower bounds, below the mirror image. No measure
has a cutoff of its own. A text's excess must also be more than ``events``
occurrences (symbols, lines, words; median words for the length of words), whatever the measure, so
that a few symbols in a text or the chance of a short one reject nothing. A group of fewer than
``min_group`` texts takes the quartiles of its language, and a language of fewer those of all texts.

Sketch rows are bounded by groups x measures x bins (64 + 32 per doubling), whatever the number
of texts; a source with a third of all rows is counted map-side first. The thresholds are
joined by (lang, source), which Spark broadcasts when small and splits when skewed otherwise.

Cases: null text has no words and fails; null lang or source is a group of its own; repeated
rows are judged each; an empty table gives no rows; other columns pass through untouched, and a
clashing name does no harm, since the verdicts are made of the four columns alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.storage import cut

# The characters that separate words, and those counted as symbols.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """The share ``num`` / ``den`` of two counts in ``m``, per mille; ``side`` 1 bounds it above, -1
    below. ``typical``: an occurrence is worth the group's median share, else one."""

    name: str
    num: str
    den: str
    side: int
    typical: bool = False

    @property
    def value(self) -> str:
        return f"{self.num} * 1000 div greatest({self.den}, 1)"


RULES = (
    Rule("symbols", "m.n_symbols", "m.word_chars", 1),
    Rule("dup_lines", "m.n_dup_lines", "m.n_lines", 1),
    Rule("variety", "m.n_unlike_words", "m.n_words", -1),
    Rule("long_words", "m.word_chars", "m.n_words", 1, typical=True),
    Rule("short_words", "m.word_chars", "m.n_words", -1, typical=True),
)
GROUP = ("lang", "source")


def words_of(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, also where lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def windows_of(hashes: Column, n: int) -> Column:
    """Hash of every n-word window, from the hashes of the words (bound by :func:`let`)."""
    return F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(hashes, i + k) for k in range(1, n))))


def _covered(windows: Column, n: int) -> Column:
    """Words that lie in a window which the text holds twice or more."""

    def places(order: Column) -> Column:
        again = F.filter(order, lambda x, k: (x.h == F.get(order, k - 1).h) | (x.h == F.get(order, k + 1).h))
        return F.array_sort(F.transform(again, lambda x: x.i))

    def words(at: Column) -> Column:
        fresh = F.transform(at, lambda i, k: F.coalesce(F.least(F.lit(n), F.get(at, k + 1) - i), F.lit(n)).cast("long"))
        return F.aggregate(fresh, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places), words)


def measures(text: Column, n: int = 5) -> Column:
    """Struct of a text's counts (null: empty)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("unlike")))
    def of_words(h: Column) -> Column:
        repeats = let(windows_of(h, n), lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0).cast("long")).otherwise(_covered(x, n)))
        return F.struct(F.size(F.array_distinct(h)).cast("long").alias("unlike"), repeats.alias("repeats"))

    return let(
        F.struct(lines.alias("lines"), let(F.transform("__words", lambda w: F.xxhash64(w)), of_words).alias("words")),
        lambda k: F.struct(
            F.size("__words").cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (k["lines"]["all"] - k["lines"]["unlike"]).cast("long").alias("n_dup_lines"),
            k["lines"]["all"].cast("long").alias("n_lines"),
            k["words"]["repeats"].alias("n_repeat_words"),
            k["words"]["unlike"].alias("n_unlike_words"),
        ),
    )


def measured(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, lang, source, text_hash, m) of every row; the texts are read once."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", *GROUP, F.xxhash64(text).alias("text_hash"), text.alias("text"), words_of(text).alias("__words"))
    return rows.select("doc_id", *GROUP, "text_hash", measures(F.col("text"), n).alias("m"))


def bin_of(value: Column) -> Column:
    """Lower edge of a value's bin: exact below 64, of relative width 1/32 above."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, rule, bin, n): the mergeable sketch of ``rows`` (lang, source, m)."""
    values = F.array(*(F.struct(F.lit(r.name).alias("rule"), bin_of(F.expr(r.value)).alias("bin")) for r in RULES))
    return rows.where("m.n_words > 0").select(*GROUP, F.explode(values).alias("x")).groupBy(*GROUP, "x.rule", "x.bin").agg(F.count("*").alias("n"))


def thresholds(sketches: DataFrame, spread: int = 6, min_group: int = 50) -> DataFrame:
    """One row per group and rule: (lang, source, rule, low, median, high) from the quartiles of the
    group, or of its language or all texts where it is small."""

    def quartiles(level: tuple[str, ...], tag: str) -> DataFrame:
        bins = sketches.groupBy(*level, "rule", "bin").agg(F.sum("n").alias("n"))
        packed = bins.groupBy(*level, "rule").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"))  # bounded by the bins

        def quantile(p: int) -> Column:
            walk = F.aggregate(
                "bins",
                F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")),
                lambda a, b: F.struct((a.seen + b.n).alias("seen"), F.when(a.at.isNull() & ((a.seen + b.n) * 100 >= F.col("size") * p), b.bin).otherwise(a.at).alias("at")),
            )
            return walk.at

        q = packed.select(*level, "rule", "size", quantile(25).alias("q1"), quantile(50).alias("q2"), quantile(75).alias("q3"))
        return q.select(*level, "rule", F.struct("size", "q1", "q2", "q3").alias(tag))

    own, lang, every = quartiles(GROUP, "own"), quartiles(GROUP[:1], "by_lang"), quartiles((), "of_all")
    lang = lang.select(F.col("lang").alias("__l"), F.col("rule").alias("__r"), "by_lang")
    every = every.select(F.col("rule").alias("__r"), "of_all")
    out = own.join(lang, F.col("lang").eqNullSafe(F.col("__l")) & (F.col("rule") == F.col("__r"))).drop("__l", "__r")
    out = out.join(every, F.col("rule") == F.col("__r")).drop("__r")
    use = F.when(F.col("own.size") >= min_group, F.col("own")).when(F.col("by_lang.size") >= min_group, F.col("by_lang")).otherwise(F.col("of_all"))
    room = (F.col("use.q3") - F.col("use.q1")) * spread
    return out.withColumn("use", use).select(*GROUP, "rule", (F.col("use.q1") - room).alias("low"), F.col("use.q2").alias("median"), (F.col("use.q3") + room).alias("high"))


def verdicts(docs: DataFrame, spread: int = 6, events: int = 8, min_group: int = 50) -> DataFrame:
    """(doc_id, lang, source, text_hash, m, base_failed, kept) of every row of ``docs``."""
    rows = cut(measured(docs))
    limits = thresholds(sketch(rows), spread, min_group)
    bound = limits.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(*(F.max(F.when(F.col("rule") == r.name, F.struct("low", "median", "high"))).alias(f"__{r.name}") for r in RULES))
    joined = rows.join(bound, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    far = F.lit(False)
    for r in RULES:
        num, den, limit = F.expr(r.num) * 1000, F.expr(r.den), F.col(f"__{r.name}")
        room = (limit.median if r.typical else F.lit(1000)) * events
        out = num > limit.high * den + room if r.side > 0 else num < limit.low * den - room
        far = far | F.coalesce(out, F.lit(False))
    failed = (F.col("m.n_words") < 10) | (F.col("m.n_repeat_words") * 100 > F.col("m.n_words") * 20)
    return joined.select("doc_id", *GROUP, "text_hash", "m", failed.alias("base_failed"), (~failed & ~far).alias("kept"))


def keep_good(docs: DataFrame, spread: int = 6, events: int = 8, min_group: int = 50) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    key = ("doc_id", *GROUP, "text_hash")
    bad = verdicts(docs, spread, events, min_group).where(~F.col("kept")).select(*(F.col(k).alias(f"__bad_{k}") for k in key)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__bad_doc_id"))
    for k in GROUP:
        same = same & F.col(k).eqNullSafe(F.col(f"__bad_{k}"))
    return docs.join(bad, same & (F.xxhash64(F.col("text").cast("string")) == F.col("__bad_text_hash")), "left_anti")
