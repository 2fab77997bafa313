"""Dense-vector Column expressions over ``array<double>``.

Spark 4.1 has no built-in vector algebra on arrays, so these are built from
higher-order functions (``zip_with`` / ``aggregate`` / ``transform``); they stay
in the JVM and are linear in the vector length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import check_metric


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(u, v) -> Column:
    return F.aggregate(F.zip_with(_c(u), _c(v), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def squared_norm(u) -> Column:
    return F.aggregate(F.transform(_c(u), lambda a: a * a), F.lit(0.0), lambda acc, x: acc + x)


def norm(u) -> Column:
    return F.sqrt(squared_norm(u))


def squared_distance(u, v) -> Column:
    return F.aggregate(F.zip_with(_c(u), _c(v), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)


def euclidean(u, v) -> Column:
    return F.sqrt(squared_distance(u, v))


def cosine(u, v) -> Column:
    return F.try_divide(dot(u, v), norm(u) * norm(v))


def constant_vector(value: float, rank: int) -> Column:
    """``[value] * rank`` as ``array<double>``."""
    return F.array_repeat(F.lit(float(value)), int(rank))


def score(metric: str, u, v) -> Column:
    """Raw score of a metric: dot product, or euclidean distance."""
    check_metric(metric)
    return dot(u, v) if metric == "dot_product" else euclidean(u, v)


def higher_is_better(metric: str) -> bool:
    return check_metric(metric) == "dot_product"


def rank_key(metric: str, raw: Column, digits: int | None = 9) -> Column:
    """Ranking key where larger is better; rounded so ties are engine-independent (``None``: not)."""
    rounded = raw if digits is None else F.round(raw, digits)
    return rounded if higher_is_better(metric) else -rounded
