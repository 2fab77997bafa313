"""Typed run configuration (one frozen object instead of parameter dicts).

Dates are ``YYYYMMDD`` strings, validated on construction and bound into SQL
as typed parameters, never spliced as text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_DAY = re.compile(r"^\d{8}$")

METRICS = ("dot_product", "euclidean_distance")


def check_day(value: str, name: str = "date") -> str:
    if not isinstance(value, str) or not _DAY.match(value):
        raise ValueError(f"{name} must be a YYYYMMDD string, got {value!r}")
    return value


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown evaluation metric {metric!r}; expected one of {METRICS}")
    return metric


@dataclass(frozen=True)
class Window:
    """Inclusive day range on the ``YYYYMMDD`` event key."""

    start: str
    end: str

    def __post_init__(self) -> None:
        check_day(self.start, "start")
        check_day(self.end, "end")
        if self.end < self.start:
            raise ValueError(f"empty window {self.start}..{self.end}")

    @property
    def start_iso(self) -> str:
        return f"{self.start[:4]}-{self.start[4:6]}-{self.start[6:]}"

    @property
    def end_iso(self) -> str:
        return f"{self.end[:4]}-{self.end[4:6]}-{self.end[6:]}"


@dataclass(frozen=True)
class SearchSpace:
    """Integer search ranges for the hyper-parameter trials."""

    rank: tuple[int, int] = (10, 50)
    regularization: tuple[int, int] = (1, 30)
    alpha: tuple[int, int] = (40, 80)
    iterations: int = 10
    n_trials: int = 20
    folds: int = 3
    seed: int = 7
    parallelism: int = 1  # fits submitted concurrently
    fold_by: str = "rows"  # contiguous folds of the ordered rows; "user": by the user's hash


@dataclass(frozen=True)
class RunConfig:
    """Everything one pipeline run needs.

    The defaults of the evaluation knobs are the reference's configured values
    (k = 20, dot product, top 100 queries, 20 % sample); the windows default to
    the spans of the bundled fixture tables.
    """

    train: Window = field(default_factory=lambda: Window("19950101", "19991231"))
    test: Window = field(default_factory=lambda: Window("20000101", "20011231"))
    # Cart adds and impressions replayed against the model (the "test day").
    replay: Window = field(default_factory=lambda: Window("20000101", "20011231"))
    # Days replayed to choose the hyper-parameters; None: the replay window itself.
    validation: Window | None = None
    k: int = 20
    metric: str = "dot_product"
    top_n_queries: int = 100
    sample_size: float = 0.2
    sample_seed: int = 1
    cold_start: str = "minus_one"  # or "drop" / "zero"
    search: SearchSpace = field(default_factory=SearchSpace)

    def __post_init__(self) -> None:
        check_metric(self.metric)
        if self.k < 1:
            raise ValueError("k must be >= 1")
        if not (0.0 < self.sample_size):
            raise ValueError("sample_size must be > 0")
        if self.cold_start not in ("minus_one", "drop", "zero"):
            raise ValueError(f"unknown cold_start {self.cold_start!r}")
