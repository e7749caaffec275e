"""Folds after a learner's first begin with the rounds that one needed, and keep the models they would have kept."""

import random

from pyspark.ml.feature import VectorAssembler

from demandspark.operators import boosting as boo
from demandspark.operators import cv
from demandspark.operators.encoding import FOLD


def _rows(spark):
    r = random.Random(8)
    rows = []
    for i in range(300):
        a, b = r.random(), r.random()
        rows.append((i, i % 3, a, b, (a > 0.5) + 0.5 * (b > 0.3) + r.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "Index long, fold int, a double, b double, demand double")


def test_rounds_needed():
    config = boo.BoostingConfig(rounds=40, patience=2, step=0.3, depth=2, first=4)
    assert boo.rounds_needed(config, []) is None
    assert boo.rounds_needed(config, [3.0, 2.0, 2.5, 2.5, 2.5, 1.0]) == 4
    assert boo.rounds_needed(config, [3.0, 2.0, 1.0]) == 3
    assert boo.with_first(config, None) is config and boo.with_first(config, 8).first == 11


def test_other_folds_are_not_grown_anew_by_doubling(spark, monkeypatch):
    train = _rows(spark)
    config = boo.BoostingConfig(rounds=64, patience=3, step=0.1, depth=1, bins=32, first=1)
    specs = [cv.LearnerSpec("x", config, ("a", "b")), cv.LearnerSpec("y", config, ("b", "a"))]
    matrix = cv.assemble(train, train.limit(5).drop(FOLD, "demand"), specs)
    fits, fit = [], boo.BoostingConfig.estimator
    monkeypatch.setattr(boo.BoostingConfig, "estimator", lambda self, rounds, fold=0, *a: (fits.append((fold, rounds)), fit(self, rounds, fold, *a))[1])
    found = cv.fit_learners(matrix, specs, n_folds=3, parallelism=2)
    by_fold = [sum(f == k for f, _ in fits) for k in range(3)]
    assert by_fold[0] > 6 and by_fold[1] + by_fold[2] < by_fold[0]  # two learners; before, each fold was grown 1, 2, 4, ... rounds
    monkeypatch.setattr(boo.BoostingConfig, "estimator", fit)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(train)
    for f in range(3):
        alone, _ = boo.boost(config, vectors.where(f"fold <> {f}"), vectors.where(f"fold = {f}"), f)
        assert alone.getNumTrees == found["x"].rounds[f]
    assert set(found) == {"x", "y"} and found["x"].oof.count() == 300
