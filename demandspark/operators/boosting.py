"""Boosted trees with early stopping by patience, and gain importances.

MLlib stops boosting at the first round that is no better, or not at all. Here a model is grown without stopping, the
held rows' loss after every round is read in one pass over them, and the rounds are cut back to the best one; if the
patience has not run out by the last round, twice as many rounds are grown. A round's tree depends on the rounds before
it and the seed only, so the cut model is the one that stopping in time would have given, and all rounds grown are at
most a small multiple of those needed.

A matrix that one task can hold is grown by one task (``growing``), which ends where the patience runs out and goes on from the rounds so far;
MLlib grows what is larger, with its rows spread over the cluster.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators.growing import Growth, best_round
from demandspark.session import ensure_checkpoint_dir
from demandspark.sources.schemas import TARGET

FEATURES = "features"
PREDICTION = "prediction"
#: Feature values, held rows included, up to which a task grows a model alone: it holds them as doubles (512 MB) while it bins them, then as bytes.
ALONE_VALUES = 1 << 26


@dataclass(frozen=True)
class BoostingConfig:
    """Settings of one boosted learner. ``rounds`` is the most there can be, ``patience`` how many rounds without a
    lower held loss end it, ``first`` how many are grown before the first look (by default twice the patience)."""

    rounds: int
    patience: int
    step: float
    depth: int
    columns: float = 1.0          # share of the features that a node looks at
    rows: float = 1.0             # share of the rows that a tree sees
    min_rows: int = 1             # rows of a leaf at least
    bins: int = 256
    seed: int = 42
    seed_by_fold: bool = False    # whether fold f is grown with seed + f
    first: int | None = None

    def estimator(self, rounds: int, fold: int = 0, features: str = FEATURES) -> GBTRegressor:
        return GBTRegressor(
            featuresCol=features, labelCol=TARGET, predictionCol=PREDICTION, lossType="squared", maxIter=rounds, stepSize=self.step,
            maxDepth=self.depth, featureSubsetStrategy="all" if self.columns >= 1 else str(self.columns), subsamplingRate=self.rows,
            minInstancesPerNode=self.min_rows, maxBins=self.bins, seed=self.seed + (fold if self.seed_by_fold else 0),
            cacheNodeIds=False, maxMemoryInMB=512)  # trees of this depth are walked sooner than node ids are saved and read


# Rounds, patience and shape of the three learners, and of the categorical learner of the first version. MLlib
# has no penalty on leaf values and gives the first tree its full weight, so learner A, which is held back by such a
# penalty alone, asks for rows in its leaves instead.
LEARNER_A = BoostingConfig(rounds=2500, patience=150, step=0.035, depth=6, min_rows=20, seed_by_fold=True)
LEARNER_B = BoostingConfig(rounds=5000, patience=200, step=0.025, depth=7, columns=0.7, rows=0.8, min_rows=20)
LEARNER_C = BoostingConfig(rounds=5000, patience=200, step=0.035, depth=6, columns=0.7, rows=0.8, min_rows=15)
LEARNER_A_V1 = BoostingConfig(rounds=4000, patience=200, step=0.035, depth=8, min_rows=15, bins=254, seed_by_fold=True)


def held_losses(model: GBTRegressionModel, held: DataFrame) -> list[float]:
    """Mean squared error on the held rows after each round, in one pass over them."""
    return list(model.evaluateEachIteration(held, "squared"))


def cut(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` rounds."""
    java = model._java_obj
    trees, weights = list(java.trees())[:rounds], list(java.treeWeights())[:rounds]
    gateway = SparkSession.active().sparkContext._gateway
    jvm = gateway.jvm
    t = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    w = gateway.new_array(jvm.double, len(weights))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        t[i], w[i] = tree, weight
    short = jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{java.uid()}_cut{rounds}", t, w)
    short.setFeaturesCol(model.getFeaturesCol())
    short.setPredictionCol(model.getPredictionCol())
    return GBTRegressionModel(short)


def alone(rows: int, columns: int) -> bool:
    """Whether a task grows a model on this many rows by itself."""
    return rows * columns <= ALONE_VALUES


def boost(config: BoostingConfig, rows: DataFrame, held: DataFrame, fold: int = 0, features: str = FEATURES) -> tuple[GBTRegressionModel, list[float]]:
    """A model grown on ``rows`` and cut by the loss on ``held``, and the losses of the rounds that were grown. The held
    rows choose the number of rounds only; no tree sees them. Without held rows all rounds are kept."""
    first = rows.select(features).first()
    n_held, n_rows = held.count(), rows.count()
    if first is not None and alone(n_rows + n_held, len(first[0])):
        return _boost_alone(config, rows, held, n_held, fold, features)
    if not n_held:
        return config.estimator(config.rounds, fold, features).fit(rows), []
    grown = min(config.rounds, config.first or 2 * config.patience)
    while True:
        model = config.estimator(grown, fold, features).fit(rows)
        losses = held_losses(model, held)
        keep, ended = best_round(losses, config.patience)
        if ended or grown >= config.rounds:
            return cut(model, keep), losses
        grown = min(config.rounds, 2 * grown)


def _boost_alone(config: BoostingConfig, rows: DataFrame, held: DataFrame, n_held: int, fold: int, features: str) -> tuple[GBTRegressionModel, list[float]]:
    """``boost`` by a task for each step, which goes on from the step before."""
    patience = config.patience
    growth = Growth(rows, held, features, patience)
    if not n_held:
        growth.on(config.estimator(config.rounds, fold, features))
        return growth.model(), []
    grown = min(config.rounds, config.first or 2 * patience)
    while True:
        losses = growth.on(config.estimator(grown, fold, features))
        keep, ended = best_round(losses, patience)
        if ended or grown >= config.rounds:
            return growth.model(keep), losses
        grown = min(config.rounds, 2 * grown)


def rounds_needed(config: BoostingConfig, losses: list[float]) -> int | None:
    """How many rounds had to be grown to see where boosting ends, given the losses of those that were."""
    if not losses:
        return None
    keep, ended = best_round(losses, config.patience)
    return keep + config.patience if ended else len(losses)


def with_first(config: BoostingConfig, rounds: int | None) -> BoostingConfig:
    """First grows ``rounds`` and a quarter more. What is kept does not depend on it, only how often a model is grown anew."""
    return config if rounds is None else replace(config, first=rounds + rounds // 4 + 1)


def node_table(model: GBTRegressionModel) -> DataFrame:
    """The nodes of all trees, written to the shared folder and read back: tree, node, feature (index; null for a
    leaf) and gain."""
    spark = SparkSession.active()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return nodes.select(F.col("treeID").alias("tree"), "nodeData.*").select(
        "tree", F.col("id").alias("node"), F.when(F.col("split.featureIndex") >= 0, F.col("split.featureIndex")).alias("feature"), "gain")


def gain_importances(nodes: DataFrame, names: list[str], top: int = 25) -> DataFrame:
    """feature, importance: the gains of the splits on each feature, added up over all trees and not normalised; the
    ``top`` highest, ties by name. Features without a split have 0."""
    spark = nodes.sparkSession
    known = spark.createDataFrame(list(enumerate(names)), "feature int, name string")  # one row for each column
    gains = nodes.filter(F.col("feature").isNotNull() & (F.col("gain") > 0)).groupBy("feature").agg(F.sum("gain").alias("importance"))
    return known.join(gains, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(
        F.col("importance").desc(), "feature").limit(top)
