"""Whitening of embeddings by a covariance weighted with multiplicities.

Entry ``c`` becomes the integer ``x = floor(1024 c) + 100000``. Identical x vectors are grouped
(counted map-side first, so a vector that fills a third of the table is one row per task); the
distinct ones carry their count, or one, as fit weight. Sums are exact integers; the covariance is a weighted
product of centred blocks, one d x d sum per task; its eigenvectors are found on the driver
(d x d numbers, whatever the number of rows). Every distinct vector is whitened once and joined
back by the SHA-256 of its entries: the fewer than ``hot`` vectors that hold more than 1/``hot`` of all rows each
are broadcast, the others go through a shuffle in which no key has more rows than that.

Cases: rows whose vector is null or holds a null, NaN or infinite entry are dropped. Vectors of
different lengths are spaces of their own, each fitted on its own rows; empty vectors have no components. Components with an
eigenvalue of zero (to rounding) are left out, so equal vectors give no rows. Null ids and repeated
rows stay. An entry beyond 2**62 counts as 2**62; a ``deviation`` beyond a long is
null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.storage import cut

SCALE, SHIFT, LONGEST = 1024, 100_000, 2**62
WEIGHTS = ("count", "one")


def entries(vector: Column) -> Column:
    """The x vector; null where ``vector`` is dropped."""
    huge = F.lit(float("inf"))
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < huge), F.lit(False)))
    x = lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LONGEST))), F.lit(float(LONGEST)))) + SHIFT
    return F.when(good, F.transform(vector, x))


def key_of(x: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", x.cast("array<string>")), 256))


@dataclass(frozen=True)
class Space:
    """The fit of the vectors of one length."""

    n: int
    sums: tuple[int, ...]
    scales: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.scales]


def _blocks(batches, columns):
    """(length, other columns, matrix of x) for the vectors of each length in each batch."""
    for batch in batches:
        x = batch.column("x")
        sizes = np.diff(x.offsets.to_numpy())
        flat = x.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            rows = flat[(starts[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d).astype(np.int64)
            yield int(d), [batch.column(c).take(pa.array(at)) for c in columns], rows


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly: as longs where they fit, else as Python integers."""
    wide = max((abs(s) for s in sums), default=0) + n * int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    if wide < 2**63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(gap: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; null beyond a long."""
    if gap.dtype != object:
        most = int(np.abs(gap).max()) if gap.size else 0
        if most**2 * max(1, gap.shape[1]) < 2**63:
            return (gap * gap).sum(1).tolist()
        gap = gap.astype(object)
    return [v if v < 2**63 else None for v in (int(sum(c * c for c in row)) for row in gap.tolist())]


def _sum_blocks(batches):
    """Rows and entry sums of each length in this task."""
    found: dict[int, tuple[int, np.ndarray]] = {}
    for d, (weight,), x in _blocks(batches, ["weight"]):
        w = weight.to_numpy(zero_copy_only=False).astype(np.int64)
        total = int(w.sum())
        most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
        part = w @ x if most * total < 2**63 else w.astype(object) @ x.astype(object)
        n, sums = found.get(d, (0, np.zeros(d, object)))
        found[d] = (n + total, sums + part.astype(object))
    for d, (n, sums) in found.items():
        values = pa.array([[Decimal(int(s)) for s in sums]], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), values], names=["d", "n", "sums"])


def _weighted_products(spaces: dict[int, tuple[int, tuple[int, ...]]]):
    def products(batches):
        found: dict[int, np.ndarray] = {}
        for d, (weight,), x in _blocks(batches, ["weight"]):
            if d:
                n, sums = spaces[d]
                c = centred(x, n, sums).astype(np.float64) / n
                w = weight.to_numpy(zero_copy_only=False).astype(np.float64)
                found[d] = found.get(d, 0.0) + c.T @ (c * w[:, None])
        for d, total in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["d", "i", "row"])

    return products


def distinct_vectors(rows: DataFrame, weights: str = "count") -> DataFrame:
    """(x, weight) of the distinct x vectors of ``rows`` (x)."""
    if weights not in WEIGHTS:
        raise ValueError(f"weights must be one of {WEIGHTS}, not {weights!r}")
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
    return cut(counted.withColumn("weight", F.col("rows") if weights == "count" else F.lit(1).cast("long")))


def fit(vectors: DataFrame, components: int = 8) -> dict[int, Space]:
    """The leading components for each length of the weighted ``vectors``."""
    read = vectors.select("x", "weight")
    parts = read.mapInArrow(_sum_blocks, "d int, n long, sums array<decimal(38,0)>")
    ns = {r.d: r.n for r in parts.groupBy("d").agg(F.sum("n").alias("n")).collect()}
    entry = parts.select("d", F.posexplode("sums").alias("i", "s")).groupBy("d", "i").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    sums: dict[int, dict[int, int]] = {d: {} for d in ns}
    for r in entry.collect():  # one row per dimension
        sums[r.d][r.i] = int(r.s)
    spaces = {d: (ns[d], tuple(sums[d][i] for i in range(d))) for d in ns}
    products = read.mapInArrow(_weighted_products(spaces), "d int, i int, row array<double>")
    cells = products.select("d", "i", F.posexplode("row").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    grams = {d: np.zeros((d, d)) for d in ns}
    for r in cells.groupBy("d", "i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row")).toLocalIterator():
        grams[r.d][r.i] = [c.v for c in r.row]  # d rows of d numbers
    out = {}
    for d, (n, s) in spaces.items():
        gram = grams[d] / n
        values, units = np.linalg.eigh((gram + gram.T) / 2) if d else (np.zeros(0), np.zeros((0, 0)))
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > max(values.max(initial=0.0), 0.0) * d * np.finfo(float).eps]
        units = units[:, order]
        signs = np.sign(units[np.abs(units).argmax(0), np.arange(len(order))]) if len(order) else np.zeros(0)
        out[d] = Space(n, s, values[order], units * signs, float(np.trace(gram)))
    return out


def whiten(vectors: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """(key, d, rows, weight, deviation, z) of every distinct vector."""

    def run(batches):
        for d, (key, rows, weight), x in _blocks(batches, ["key", "rows", "weight"]):
            s = spaces[d]
            gap = centred(x, s.n, s.sums)
            z = (gap.astype(np.float64) / s.n) @ s.vectors / np.sqrt(s.scales)
            out = [key, pa.array([d] * len(x), pa.int32()), rows, weight, pa.array(deviations(gap), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, names=["key", "d", "rows", "weight", "deviation", "z"])

    read = vectors.select(key_of(F.col("x")).alias("key"), "rows", "weight", "x")
    return cut(read.mapInArrow(run, "key binary, d int, rows long, weight long, deviation long, z array<double>"))


def identity_errors(white: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """For each length the largest absolute entry of z's weighted covariance minus the identity."""
    out = {}
    for d, s in spaces.items():
        k, z, w = len(s.scales), lambda i: F.col("z")[i], F.col("weight")
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        if not pairs:
            continue
        first = [F.sum(w * z(i)).alias(f"m{i}") for i in range(k)]
        second = [F.sum(w * z(i) * z(j)).alias(f"c{i}_{j}") for i, j in pairs]
        r = white.where(F.col("d") == d).agg(*first, *second).first()
        out[d] = max(abs(r[f"c{i}_{j}"] / s.n - r[f"m{i}"] / s.n * r[f"m{j}"] / s.n - (i == j)) for i, j in pairs)
    return out


def whitened(df: DataFrame, vector: str = "embedding", ident: str = "vec_id", components: int = 8, weights: str = "count", hot: int = 1000) -> DataFrame:
    """(ident, d, component from 1, n, deviation, whitened, explained, identity_error) of every
    row whose vector is kept."""
    rows = df.select(F.col(ident), entries(F.col(vector)).alias("x")).where("x is not null")
    vectors = distinct_vectors(rows, weights)
    spaces = fit(vectors, components)
    white = whiten(vectors, spaces)
    errors = identity_errors(white, spaces)
    total = white.agg(F.sum("rows")).first()[0] or 0
    keyed = rows.select(F.col(ident), key_of(F.col("x")).alias("key"))
    result = white.select("key", "d", "deviation", "z", (F.col("rows") > total / hot).alias("__hot"))
    few = F.broadcast(result.where("__hot").drop("__hot"))  # fewer than `hot` rows
    back = keyed.join(few, "key").unionByName(keyed.join(few.select("key"), "key", "left_anti").join(result.where("not __hot").drop("__hot"), "key"))
    fits = [(d, s.n, s.explained, errors.get(d)) for d, s in spaces.items()]
    fitted = df.sparkSession.createDataFrame(fits, "d int, n long, explained array<double>, identity_error double")
    long = back.select(ident, "d", "deviation", F.posexplode("z").alias("place", "whitened")).join(F.broadcast(fitted), "d")
    return long.select(ident, "d", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", "place").alias("explained"), "identity_error")
