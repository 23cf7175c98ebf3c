"""Boosted models on ordered target statistics, their tuning on rolling folds, and keeping them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, functions as F

from matchcast.operators.encode import alike_sums, assemble, full_statistics, known_statistics, target_statistics
from matchcast.operators.evaluate import accuracy
from matchcast.shared import BROADCAST_BYTES, cut, kept, remove

#: Categorical columns of the played maps, the grids that are searched, and the learner's usual rounds and depth.
CATEGORICAL = ["team_1", "team_2", *(f"player{i}_team{s}" for s in (1, 2) for i in range(1, 6)), "map", "team_rank_1", "team_rank_2"]
GRID = {"learning_rate": [0.3, 0.2, 0.1], "depth": [4, 5, 6, 8, 10], "iterations": [100, 200, 500, 1000]}
LEAF_GRID = {"learning_rate": [0.3, 0.2, 0.1], "depth": [4, 6, 10], "l2_leaf_reg": [1, 5, 9]}
ITERATIONS, DEPTH, RATE = 1000, 6, 0.1


class Booster:
    """A boosted regressor, or classifier of 0 and 1, with categorical columns as statistics of the target.

    Training rows get the statistics of the rows before them, new rows those of all training rows; values that are new get the prior."""

    def __init__(self, numeric: list[str], categorical: list[str], target: str, classifier: bool = False, iterations: int = ITERATIONS, depth: int = DEPTH, rate: float = RATE, seed: int = 7, prior: float = 0.5):
        self.numeric, self.categorical, self.target, self.classifier, self.prior = numeric, categorical, target, classifier, prior
        kind = GBTClassifier if classifier else GBTRegressor
        self.learner = kind(featuresCol="features", labelCol=target, maxIter=iterations, maxDepth=min(depth, 30), stepSize=rate, seed=seed)
        self.model = None
        self.statistics: DataFrame | None = None

    def fit(self, rows: DataFrame, seq: str = "seq", validation: str | None = None, tolerance: float = 0.0, view: Callable[[DataFrame], DataFrame] | None = None) -> Booster:
        """``validation`` names a boolean column: rounds end where its rows gain no more than the tolerance, and the best round stays.
        ``view`` adds the columns that the rows lack; rows are exchanged without these. What the learner reads is kept until it has, and a
        statistic that several columns share once."""
        wide = view(rows) if view else rows
        train, folders = wide, []

        def keep(df: DataFrame) -> DataFrame:
            found, folder = kept(df, "statistics")
            folders.append(folder)
            return found

        self.statistics = None
        if self.categorical:
            needed = list(dict.fromkeys([*self.numeric, self.target, *([validation] if validation else [])]))
            sets, sums, folder = alike_sums(rows, self.categorical, self.target, seq, view)
            self.statistics = cut(full_statistics(sets, sums, self.prior))
            train = target_statistics(rows, self.categorical, self.target, self.means, self.prior, seq=seq, view=view, kept=needed, sums=(sets, sums), keep=keep)
            remove(rows.sparkSession, folder)
        learner = self.learner
        if validation:
            learner = learner.copy().setValidationIndicatorCol(validation)
            learner.set(learner.validationTol, tolerance)
        self.model = learner.fit(assemble(train, self.inputs))
        for folder in folders:
            remove(rows.sparkSession, folder)
        return self

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *self.means]

    @property
    def means(self) -> list[str]:
        return [f"{c}_mean" for c in self.categorical]

    def predict(self, rows: DataFrame, out: str = "p") -> DataFrame:
        """Adds the prediction, or the chance of 1."""
        if self.categorical:
            sizes = self.statistics.groupBy("column").count().collect()
            small = {r["column"] for r in sizes if r["count"] * 64 <= BROADCAST_BYTES}
            rows = known_statistics(rows, self.statistics, self.categorical, self.means, self.prior, small)
        scored = self.model.transform(assemble(rows, self.inputs))
        value = vector_to_array("probability")[1] if self.classifier else F.col("prediction")
        gone = {"features", "prediction", "rawPrediction", "probability", *self.means}
        return scored.withColumn(out, value).drop(*gone)

    def save(self, path: str) -> None:
        """The trees and the statistics, as folders below ``path``."""
        PipelineModel([self.model]).write().overwrite().save(f"{path}/trees")
        if self.categorical:
            self.statistics.write.mode("overwrite").parquet(f"{path}/statistics")

    def load(self, spark, path: str) -> Booster:
        self.model = PipelineModel.load(f"{path}/trees").stages[0]
        self.statistics = spark.read.parquet(f"{path}/statistics") if self.categorical else None
        return self


def grid(points: dict[str, list]) -> list[dict]:
    return [dict(zip(points, values, strict=True)) for values in product(*points.values())]


def search(folds: DataFrame, make, points: Iterable[dict], target: str, seq: str = "seq") -> list[tuple[dict, float]]:
    """Mean accuracy over the folds for each grid point, in the points' order. ``make(**point)`` gives an unfitted booster.

    Fits are distributed; what the driver loops over is grid points and folds, not rows."""
    numbers = sorted(r["fold"] for r in folds.select("fold").distinct().collect())
    parts = {f: folds.where(F.col("fold") == f).drop("fold", "k").cache() for f in numbers}
    found = []
    for point in points:
        scores = []
        for rows in parts.values():
            model = make(**point).fit(rows.where("part = 'train'").drop("part"), seq)
            scores.append(accuracy(model.predict(rows.where("part = 'validation'").drop("part")), "p", target).first()["accuracy"])
        found.append((point, sum(scores) / len(scores)))
    for rows in parts.values():
        rows.unpersist()
    return found


def best(found: list[tuple[dict, float]]) -> tuple[dict | None, float]:
    """The first of the best points; a score of 0 is never chosen."""
    point, top = None, 0.0
    for p, s in found:
        if s > top:
            point, top = p, s
    return point, top
