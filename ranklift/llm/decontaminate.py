"""Finds benchmark items in documents: SimHash windows, Hamming blocks, exact verification.

1. *Windows.* An item of n words is compared with document windows of n words. A window that is
   similar at all contains a word shingle of an item, at whatever place, so shingles of all
   documents are matched with the items' (a semi-join on a hash), and every window of the items'
   sizes that contains a match is taken; their starts are kept as intervals until then.
2. *Fingerprints.* 64 sums of shingle signs, by multiplicity, in column expressions that add
   several of them in one long.
3. *Blocks.* The 64 bits are cut into ``radius + 1`` blocks. Two fingerprints within ``radius``
   agree in one block at least, so equality on (size, block) finds all of them.
4. *Verification.* Bag-of-shingles similarity (sum of smaller over sum of larger counts) of the
   window and the item, at or above ``percent``; the best window of each item is returned.

The benchmark is the fixed, small side: its shingles are broadcast when there are at most
``broadcast_shingles`` (counted first), and joined by a shuffle beyond that. Documents never
meet each other. A passage in a third of all documents gives each of them its few windows.

Shingles take five words, or the whole item where it is shorter. Words are case-folded and
separated by white space. Cases: null or word-less texts and items match nothing; a document
shorter than the item is one window; rows that repeat doc_id and text are returned once; null
ids are kept; equal items match each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.quality import let, windows_of, words_of
from ranklift.llm.storage import cut

SHINGLE = 5
BITS = 64


def _shingles(text: Column, k: Column | int) -> Column:
    """Hash of every k-word window of a text (k up to 5)."""
    hashes = F.transform(words_of(F.lower(text.cast("string"))), lambda w: F.xxhash64(w))
    if isinstance(k, int):
        return let(hashes, lambda h: windows_of(h, k)) if k > 1 else F.transform(hashes, lambda x: F.xxhash64(x))
    by_size = lambda h: reduce(lambda rest, n: F.when(k == n, windows_of(h, n)).otherwise(rest), range(1, SHINGLE), windows_of(h, SHINGLE))
    return let(hashes, by_size)


def fingerprint(shingles: Column) -> Column:
    """SimHash: bit b is set when more shingles (by multiplicity) have it than not."""

    def lanes(width: int) -> Column:
        """For up to 2 ** (width - 1) - 2 shingles: every ``width``-th bit is counted in its own
        lane of one long; with the bias, a lane's second bit says whether its count exceeds the
        half. The top bit stays free, so that no sum overflows."""
        mask = F.lit(sum(1 << at for at in range(0, BITS, width))).cast("long")
        bias = F.lit((1 << (width - 2)) - 1).cast("long") - F.call_function("shiftright", F.size(shingles), F.lit(1)).cast("long")

        def part(j: int) -> Column:
            counts = F.aggregate(shingles, bias * mask, lambda a, x: a + F.call_function("shiftrightunsigned", x, F.lit(j)).bitwiseAND(mask))
            return F.call_function("shiftleft", F.call_function("shiftrightunsigned", counts, F.lit(width - 2)).bitwiseAND(mask), F.lit(j))

        return reduce(Column.bitwiseOR, map(part, range(width)))

    n = F.size(shingles)
    return F.when(n <= (1 << 7) - 2, lanes(8)).when(n <= (1 << 15) - 2, lanes(16)).otherwise(lanes(32))


def blocks(print_: Column, radius: int) -> Column:
    """(block, value) of ``radius + 1`` blocks of the bits."""
    n = min(radius + 1, BITS)
    edges = [BITS * i // n for i in range(n + 1)]
    parts = [F.struct(F.lit(i).alias("block"), F.call_function("shiftrightunsigned", print_, F.lit(a)).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return F.array(*parts)


def similarity(a: Column, b: Column) -> tuple[Column, Column]:
    """(sum of smaller, sum of larger counts) over the shingles of two bags."""
    count = lambda xs, y: F.size(F.filter(xs, lambda z: z == y))
    common = F.array_intersect(a, b)
    counted = F.aggregate(F.transform(common, lambda y: F.least(count(a, y), count(b, y)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    once = F.size(F.array_distinct(b)) == F.size(b)  # then no smaller count is above 1
    both = F.when(once, F.size(common).cast("long")).otherwise(counted)
    return both, F.size(a) + F.size(b) - both


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, k, shingles, print) of the items that have words."""
    n = F.size(words_of(F.lower(F.col("text").cast("string"))))
    rows = benchmark.select("item_id", "text", n.alias("n")).where("n > 0").withColumn("k", F.least("n", F.lit(SHINGLE)))
    rows = rows.select("item_id", "n", "k", _shingles(F.col("text"), F.col("k")).alias("shingles"))
    return rows.withColumn("print", fingerprint(F.col("shingles")))


def _starts(at: Column) -> Column:
    """Intervals (lo, hi), apart from each other, of the starts of all n-word windows that contain
    a shingle at one of the sorted places ``at`` of a text with ``size`` shingles of k words."""
    reach = F.col("n") - F.col("k")  # a window that starts so far before a shingle ends with it
    last = F.greatest(F.col("size") - 1 - reach, F.lit(0))
    opens = F.filter(at, lambda x, i: F.coalesce(x - reach > F.get(at, i - 1) + 1, F.lit(True)))
    shuts = F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) - reach > x + 1, F.lit(True)))
    return F.zip_with(opens, shuts, lambda x, y: F.struct(F.greatest(x - reach, F.lit(0)).alias("lo"), F.least(y, last).alias("hi")))


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = 75, radius: int = 24, broadcast_shingles: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item_id, start, n_words, similarity): the best window of every item
    that a document holds; ``start`` counts words from 0."""
    wanted = cut(items(benchmark))
    have = wanted.agg(F.sum(F.size("shingles")), F.collect_set("k")).first()
    small = (have[0] or 0) <= broadcast_shingles
    ship = F.broadcast if small else (lambda df: df)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    known = wanted.select("k", "n", F.explode("shingles").alias("shingle")).distinct()
    found = []
    for k in sorted(have[1]) or [SHINGLE]:
        at = rows.select("doc_id", "text_hash", _shingles(F.col("text"), k).alias("all")).select("doc_id", "text_hash", F.size("all").alias("size"), F.posexplode("all").alias("pos", "shingle"))
        found.append(at.join(ship(known.where(F.col("k") == k)), "shingle").select("doc_id", "text_hash", "k", "n", "size", "pos"))
    at = reduce(DataFrame.union, found).groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "k", "n").agg(F.max("size").alias("size"), F.collect_set("pos").alias("at"))
    at = at.select("__doc", "__hash", F.struct("k", "n", let(F.array_sort("at"), _starts).alias("starts")).alias("p"))
    places = cut(at.groupBy("__doc", "__hash").agg(F.collect_list("p").alias("places")))  # a document's own intervals

    held = rows.join(places, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))).dropDuplicates(["__doc", "__hash"])
    by_size = F.array(*(_shingles(F.col("text"), k) for k in range(1, SHINGLE + 1)))
    size = lambda p: p.n - p.k + 1  # noqa: E731  shingles of a window
    piece = lambda all_, p, r: F.slice(F.get(all_, p.k - 1), r.lo + 1, r.hi - r.lo + size(p))
    pieces = let(by_size, lambda all_: F.flatten(F.transform("places", lambda p: F.transform(p.starts, lambda r: F.struct(p.n.alias("n"), size(p).alias("size"), r.lo.alias("lo"), r.hi.alias("hi"), piece(all_, p, r).alias("all"))))))
    windows = held.select("doc_id", "text_hash", F.explode(pieces).alias("p")).select("doc_id", "text_hash", "p", F.explode(F.sequence("p.lo", "p.hi")).alias("start"))
    windows = windows.select("doc_id", "text_hash", F.col("p.n").alias("n"), "start", F.slice("p.all", F.col("start") - F.col("p.lo") + 1, F.col("p.size")).alias("bag"))
    windows = windows.withColumn("print", fingerprint(F.col("bag")))

    left = windows.select("*", F.explode(blocks(F.col("print"), radius)).alias("b")).select("doc_id", "text_hash", "n", "start", "bag", "print", "b.block", "b.value")
    right = wanted.select("item_id", "n", "shingles", F.col("print").alias("item_print"), F.explode(blocks(F.col("print"), radius)).alias("b")).select("item_id", "n", "shingles", "item_print", "b.block", "b.value")
    pairs = left.join(ship(right), ["n", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    both, either = similarity(F.col("bag"), F.col("shingles"))
    # a pair meets in every block it agrees in; the first of them speaks for it
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    first = F.array_min(F.transform(F.filter(blocks(differ, radius), lambda b: b.value == 0), lambda b: b.block))
    scored = pairs.where(first == F.col("block")).select("doc_id", "text_hash", "item_id", "start", "n", both.alias("both"), either.alias("either")).where(F.col("both") * 100 >= F.col("either") * percent)
    best = scored.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct(F.col("both") / F.col("either"), (-F.col("start")).alias("start"), "n")).alias("m"))
    return best.select("doc_id", "text_hash", "item_id", (-F.col("m.start")).cast("long").alias("start"), F.col("m.n").cast("long").alias("n_words"), F.col("m.col1").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    bad = matches(docs, benchmark, **options).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash")), "left_anti")
