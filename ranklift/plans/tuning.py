"""M6 + M7 as ``pyspark.ml`` parts: an estimator, an evaluator, a cross-validator over our folds.

``ImplicitRanker`` fits implicit ALS; its model's ``transform`` gives the replay's rows with the
model's predictions, whatever the dataset: the held-out fold only shrinks the training data and the
score is the replay's, as in the reference. ``ReplayEvaluator`` turns those rows into the mean average
improvement (larger is better), so both fit into ``CrossValidator(foldCol=...)`` and
``TrainValidationSplit``. ``search.search`` does the same for many fits in one replay job and is the
way for large searches; this surface is for users who tune with ``pyspark.ml``.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.factors import ALSParams, fit_als, kfold_assign
from .search import ReplayScorer


class _RankerParams(Params):
    rank = Param(Params._dummy(), "rank", "length of the vectors", TypeConverters.toInt)
    regularization = Param(Params._dummy(), "regularization", "lambda of the objective", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "weight of a rating in the confidence", TypeConverters.toFloat)
    iterations = Param(Params._dummy(), "iterations", "alternations", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the first vectors", TypeConverters.toInt)

    def als_params(self) -> ALSParams:
        return ALSParams(*(self.getOrDefault(p) for p in (self.rank, self.regularization, self.alpha, self.iterations, self.seed)))


class ImplicitRanker(Estimator, _RankerParams):
    """Fits on ``(userid, itemid, rating)``; ``scorer`` holds the replay that models are judged by."""

    def __init__(self, scorer: ReplayScorer, dictionary: DataFrame | None = None, **params):
        super().__init__()
        self.scorer = scorer
        self.dictionary = dictionary
        defaults = ALSParams()
        self._setDefault(rank=defaults.rank, regularization=defaults.regularization, alpha=defaults.alpha, iterations=defaults.iterations, seed=defaults.seed)
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> ImplicitRankerModel:
        users, items = fit_als(dataset.select("userid", "itemid", "rating"), self.als_params(), dictionary=self.dictionary)
        return self._copyValues(ImplicitRankerModel(users, items, self.scorer).setParent(self))


class ImplicitRankerModel(Model, _RankerParams):
    def __init__(self, users: DataFrame, items: DataFrame, scorer: ReplayScorer):
        super().__init__()
        self.users, self.items, self.scorer = users, items, scorer

    def setParent(self, parent: ImplicitRanker) -> ImplicitRankerModel:
        self._resetUid(parent.uid)
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.scorer.predictions(self.users, self.items)


class ReplayEvaluator(Evaluator):
    """The mean average improvement of predicted replay rows; NaN where there are no pairs."""

    def __init__(self, scorer: ReplayScorer):
        super().__init__()
        self.scorer = scorer

    def statistics(self, predicted: DataFrame) -> DataFrame:
        return self.scorer.improvement_of(predicted)

    def _evaluate(self, dataset: DataFrame) -> float:
        row = self.statistics(dataset).first()
        return math.nan if row is None or row["mai"] is None else float(row["mai"])

    def isLargerBetter(self) -> bool:
        return True


def cross_validate(train: DataFrame, scorer: ReplayScorer, grid: list[dict], folds: int = 3, fold_by: str = "user", parallelism: int = 1, **params) -> CrossValidatorModel:
    """``CrossValidator`` over the library's folds: ``fold_by`` as in ``kfold_assign``.

    ``grid``: parameter maps of ``ImplicitRanker`` by name. The ratings are folded once.
    """
    ranker = ImplicitRanker(scorer, **params)
    maps = [{ranker.getParam(k): v for k, v in point.items()} for point in grid]
    folded = kfold_assign(train, folds, fold_by).withColumn("fold", (F.col("fold") - 1).cast("int")).persist()
    try:
        cv = CrossValidator(estimator=ranker, estimatorParamMaps=maps, evaluator=ReplayEvaluator(scorer), numFolds=folds, foldCol="fold", parallelism=parallelism)
        return cv.fit(folded)
    finally:
        folded.unpersist()
