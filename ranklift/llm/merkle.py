"""Merkle manifest of a table: one tree per group, one over the groups, a proof for every row.

Leaves of a group stand in order; every 8 consecutive nodes (the last run may be shorter, even
one node) become their hash, until one node remains: the group's subroot. The subroots, ordered
by group, become the root in the same way. H is the lower-case hex SHA-256 of its inputs
concatenated, digests as hex text. A row's proof is its siblings, level by level up to the root.

How it is spread: rows are range-partitioned by (group, order) and numbered inside their task,
with the counts of earlier tasks added. ``8 ** levels`` consecutive leaves are a superblock.
Each superblock is reduced to its top in a group of its own, the tops are reduced in the same way,
round by round, until every group has one node. Back down, the nodes of a round are cogrouped by
superblock with the outer nodes that their superblock needs (one row: siblings up to the root),
and ``applyInPandas`` finishes the reduction inside, joins the proofs and folds claimed leaves. No
task ever holds more than a superblock and one outer row, however many rows a group has.

Cases: nulls in any column are part of the leaf (``-``); a null group comes first; a null id comes
first in its group; rows with the same id are ordered by leaf, and equal rows are leaves of their own; an empty table
gives no rows; a single row is its own subroot and root, with the hash of nothing as its proof;
texts are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.storage import cut, groups

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """H of a document's fields; ``changed`` replaces some of them."""
    return F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def _number_in_task(batches):
    """``__local``: 0, 1, ... within each run of one group, in rows sorted by group."""
    last, count = None, 0
    for batch in batches:
        local = []
        for g in batch.column("g").to_pylist():
            count = count + 1 if g == last else 0
            last = g
            local.append(count)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*batch.schema.names, "__local"])


def number(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a string ``g``) and ``pos``: 0, 1, ... within ``g`` by ``order``.

    Equal rows are told apart by their place, so that no key is too hot for a task.
    """
    rows = rows.withColumn("__copy", F.monotonically_increasing_id())
    keys = ["g", *order, "__copy"]
    ranged = rows.repartitionByRange(groups(rows.sparkSession), *keys).sortWithinPartitions(*keys).drop("__copy")
    ranged = ranged.withColumn("__task", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    placed = cut(ranged.mapInArrow(_number_in_task, f"{schema}, __local long"))
    sizes = placed.groupBy("g", "__task").agg((F.max("__local") + 1).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("g").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    # only the first group of a task began in an earlier one: a row for each task at most
    begun = sizes.select("g", "__task", before.alias("__before")).where("__before > 0")
    out = placed.join(F.broadcast(begun), ["g", "__task"], "left")
    return out.withColumn("pos", F.col("__local") + F.coalesce("__before", F.lit(0))).drop("__local", "__before", "__task")


def inner_levels(n: int, block: int, levels: int) -> int:
    """Levels of the tree inside a superblock of ``n`` nodes: all, unless it is the only one."""
    if block > 0 or n == ARITY**levels:
        return levels
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


def reduce_up(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes, and each of the levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def siblings(level: list[str], i: int) -> tuple[str, str]:
    """What stands left and right of node ``i`` in its run."""
    run = i - i % ARITY
    return "".join(level[run:i]), "".join(level[i + 1 : run + ARITY])


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / ARITY**levels).cast("long")


def rounds_of(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (g, pos, node), the tops of their superblocks, and so on to one node a group."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree = reduce_up(rows["node"].tolist(), inner_levels(len(rows), key[1], levels))
        return pd.DataFrame({"g": [key[0]], "pos": [key[1]], "node": tree[-1]})

    out = [nodes]
    while True:
        upper = out[-1].select("g", "pos", "node").groupBy("g", _block(levels).alias("block")).applyInPandas(top, "g string, pos long, node string")
        out.append(cut(upper))
        if not out[-1].where("pos > 0").head(1):
            return out


OUTER = "g string, pos long, node string, subroot string, root string, lefts array<string>, rights array<string>"


def exchange(nodes: DataFrame, outer: DataFrame, levels: int, finish, schema: str) -> DataFrame:
    """Nodes and the outer row of their superblock, cogrouped; ``finish(rows, tree, outer row)``."""

    def join(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        tree = reduce_up(rows["node"].tolist(), inner_levels(len(rows), key[1], levels))
        if len(above) != 1 or tree[-1] != [above["node"][0]]:
            raise RuntimeError(f"superblock {key} does not reduce to its outer node")
        return finish(rows, tree, above.iloc[0])

    left = nodes.withColumn("block", _block(levels)).groupBy("g", "block")
    return left.cogroup(outer.withColumnRenamed("pos", "block").groupBy("g", "block")).applyInPandas(join, schema)


def _pass_down(rows: pd.DataFrame, tree: list[list[str]], above) -> pd.DataFrame:
    lefts, rights = [], []
    for i in range(len(rows)):
        steps = [siblings(level, i // ARITY**n) for n, level in enumerate(tree[:-1])]
        lefts.append([x for x, _ in steps] + list(above["lefts"]))
        rights.append([x for _, x in steps] + list(above["rights"]))
    out = rows[["g", "pos", "node"]].assign(subroot=above["subroot"], root=above["root"])
    return out.assign(lefts=lefts, rights=rights)


def _finish(rows: pd.DataFrame, tree: list[list[str]], above) -> pd.DataFrame:
    """Proofs and folded roots of a superblock's leaves."""
    outer = list(zip(above["lefts"], above["rights"], strict=True))
    over = ["".join(a + b for a, b in outer)]  # proof text above each node, from the top down
    inside = tree[:-1]
    for level in reversed(inside):
        over = ["".join(siblings(level, i)) + over[i // ARITY] for i in range(len(level))]
    proofs = [digest(x) for x in over]
    folded = []
    for i, node in enumerate(rows["claimed"]):
        for level in inside:
            left, right = siblings(level, i)
            node, i = digest(left + node + right), i // ARITY
        for left, right in outer:
            node = digest(left + node + right)
        folded.append(node)
    out = rows[["id", "g", "pos", "node"]].assign(subroot=above["subroot"], root=above["root"])
    return out.assign(proof_sha256=proofs, proof_length=[len(x) // 64 for x in over], folded_root=folded)


def _outer(rounds: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """Outer rows of the superblocks of ``rounds[0]``, from those of the last round down."""
    outer = top
    for nodes in reversed(rounds[1:-1]):
        outer = cut(exchange(nodes, outer, levels, _pass_down, OUTER))
    return outer


def prove(leaves: DataFrame, order: list[str], levels: int = 4) -> DataFrame:
    """Leaves (``id``, string ``g``, ``node``, ``claimed`` and the columns of ``order``) with
    ``pos``, their group's ``subroot``, the ``root``, the proof's hash and number of siblings, and the
    ``folded_root`` that ``claimed`` gives with the original siblings."""
    placed = number(leaves, [*order, "node", "claimed"]).select("id", "g", "pos", "node", "claimed")
    rounds = rounds_of(placed, levels)
    none = F.array().cast("array<string>")
    # the tree over the groups: their subroots in order, all in one group
    roots = number(rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "node"), ["name"])
    over = rounds_of(roots.select("g", "pos", "node"), levels)
    top = over[-1].select("g", "pos", "node", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), none.alias("lefts"), none.alias("rights"))
    down = exchange(roots.select("g", "pos", "node"), _outer(over, top, levels), levels, _pass_down, OUTER)
    named = down.drop("g").join(roots.select("pos", F.col("name").alias("g")), "pos")
    outer = cut(named.select("g", F.lit(0).cast("long").alias("pos"), "node", F.col("node").alias("subroot"), "root", "lefts", "rights"))
    schema = "id string, g string, pos long, node string, subroot string, root string, proof_sha256 string, proof_length int, folded_root string"
    return exchange(placed, _outer(rounds, outer, levels), levels, _finish, schema)


def leaves_of(docs: DataFrame, tampered: Column) -> DataFrame:
    """A leaf for each document, and the one claimed for it with ``tampered`` as its text."""
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))  # null first
    leaf = leaf_hash()
    claimed = F.when(tampered.eqNullSafe(F.col("text")), leaf).otherwise(leaf_hash(text=tampered))
    return docs.select(F.col("doc_id").alias("key"), F.col("doc_id").cast("string").alias("id"), group.alias("g"), leaf.alias("node"), claimed.alias("claimed"))


def lowered_third(doc_id: Column, text: Column) -> Column:
    """``text`` with A-Z lower-cased where 3 divides the CRC-32 of the decimal ``doc_id``."""
    picked = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(picked, F.translate(text, UPPER, LOWER)).otherwise(text)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = 4) -> DataFrame:
    """(doc_id, lang group's ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``,
    ``pos``, ``proof_length``) of every row of ``docs``; ``tampered`` (default: ``text``) is
    what a holder claims the text to be."""
    kind = docs.schema["doc_id"].dataType
    leaves = cut(leaves_of(docs, F.col("text") if tampered is None else tampered))  # texts are read once
    out = prove(leaves, ["key"], levels)
    return out.select(
        F.col("id").cast(kind).alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "pos", "proof_length",
    )
