"""A model that one task grows alone: MLlib's trees, whatever the partitions and steps, and MLlib is not asked to fit."""

import dataclasses
import random
import re

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from demandspark.operators import boosting as boo
from demandspark.operators import cv, growing

PLAIN = boo.BoostingConfig(rounds=60, patience=4, step=0.1, depth=4, bins=32, min_rows=5, first=4)
DRAWN = dataclasses.replace(PLAIN, rows=0.8, columns=0.6)


@pytest.fixture(scope="module")
def vectors(spark):
    r, rows = random.Random(4), []
    for i in range(700):
        a, b, c = r.random(), round(r.random(), 2), r.choice("uvwxyz")
        rows.append((i, i % 5, a, b, r.gauss(0, 1), 7.0, c, (a > 0.5) + 0.5 * (b > 0.3) * (a > 0.2) + "uvwxyz".index(c) % 3 + r.gauss(0, 0.3)))
    df = spark.createDataFrame(rows, "Index long, fold int, a double, b double, n double, same double, c string, demand double")
    df = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="keep").fit(df).transform(df)
    return VectorAssembler(inputCols=["same", "a", "b", "n", "ci"], outputCol="features", handleInvalid="keep").transform(df)


def _tree_lines(model):
    return model.toDebugString.split("\n", 1)[1].splitlines()


def _numbers(line):
    return [float(x) for x in re.findall(r"-?\d+\.?\d*(?:E-?\d+)?", line)]


def _parts(df, fold=0):
    return df.where(f"fold <> {fold}"), df.where(f"fold = {fold}")


def test_small_fits_do_not_ask_mllib(vectors, monkeypatch):
    def refuse(*a, **k):
        raise AssertionError("MLlib was asked to fit")

    monkeypatch.setattr(GBTRegressor, "fit", refuse)
    model, losses = boo.boost(DRAWN, *_parts(vectors))
    keep, ended = boo.best_round(losses, DRAWN.patience)
    assert ended and model.getNumTrees == keep > 1 and len(losses) == keep + DRAWN.patience  # not a round more than the patience needs
    mse = model.transform(vectors.where("fold = 0")).agg(F.avg((F.col("demand") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(losses[keep - 1])


def test_without_draws_the_trees_are_those_of_mllib(vectors, monkeypatch):
    own, losses = boo.boost(PLAIN, *_parts(vectors))
    monkeypatch.setattr(boo, "ALONE_VALUES", 0)
    theirs, reference = boo.boost(PLAIN, *_parts(vectors))
    assert own.getNumTrees == theirs.getNumTrees and losses == pytest.approx(reference[: len(losses)])
    a, b = _tree_lines(own), _tree_lines(theirs)
    assert len(a) == len(b) and all(_numbers(x) == pytest.approx(_numbers(y), abs=1e-9) for x, y in zip(a, b, strict=True))
    gains = [boo.node_table(m).agg(F.sum("gain"), F.count("feature")).first() for m in (own, theirs)]
    assert list(gains[0]) == pytest.approx(list(gains[1]))


def test_partitions_and_steps_do_not_matter(vectors):
    model, losses = boo.boost(DRAWN, *_parts(vectors))
    other, again = boo.boost(dataclasses.replace(DRAWN, first=60), *_parts(vectors.repartition(7, "b")))
    assert again == pytest.approx(losses) and _tree_lines(model) == _tree_lines(other)
    seeded, _ = boo.boost(dataclasses.replace(DRAWN, seed=7), *_parts(vectors))
    assert _tree_lines(seeded) != _tree_lines(model)


def test_all_rounds_are_grown_without_held_rows(vectors):
    model, losses = boo.boost(dataclasses.replace(DRAWN, rounds=6), vectors, vectors.where("false"))
    assert model.getNumTrees == 6 and losses == []


@pytest.mark.parametrize("wrong", ["cast(null as double)", "double('NaN')"])
def test_labels_that_are_no_numbers_raise(vectors, wrong):
    bad = vectors.withColumn("demand", F.expr(f"if(Index = 3, {wrong}, demand)"))
    with pytest.raises(Exception, match="label"):
        boo.boost(PLAIN, *_parts(bad))


def test_rows_with_equal_or_null_keys(vectors):
    odd = vectors.withColumn("Index", F.expr("if(Index % 7 = 0, null, Index div 2)"))
    model, losses = boo.boost(PLAIN, *_parts(odd))
    assert model.getNumTrees > 1 and losses == pytest.approx(boo.boost(PLAIN, *_parts(vectors))[1])


def test_thresholds_are_nearest_to_equal_shares():
    r = np.random.default_rng(3)
    for column in (r.integers(0, 400, 3000) ** 2.0, r.normal(size=500), np.repeat([1.0, 2.0, 5.0], [1, 900, 1])):
        values, counts = np.unique(column, return_counts=True)
        for bins in (2, 16, 64):
            splits, share, so_far, target = min(bins, len(column)) - 1, len(column) / min(bins, len(column)), counts[0], 0.0
            expected, target = [], share
            for i in range(1, len(values)):
                before, so_far = so_far, so_far + counts[i]
                if len(values) - 1 <= splits or abs(before - target) < abs(so_far - target):
                    expected.append((values[i - 1] + values[i]) / 2)
                    target += share
            assert list(growing.thresholds(column, bins)) == expected


def test_folds_of_a_small_matrix_are_all_under_way(vectors, monkeypatch):
    """The other folds begin before a learner's first one has ended."""
    train = vectors.select("Index", "fold", "a", "b", "demand")
    spec = cv.LearnerSpec("x", dataclasses.replace(DRAWN, rounds=2, first=None), ("a", "b"))
    matrix = cv.assemble(train, train.limit(5).drop("fold", "demand"), [spec])
    import threading
    others, boost = threading.Semaphore(0), cv.boost

    def waiting(config, rows, held, f):
        if f:
            others.release()
        else:
            assert others.acquire(timeout=60) and others.acquire(timeout=60)
        return boost(config, rows, held, f)

    monkeypatch.setattr(cv, "boost", waiting)
    assert matrix.alone and cv.fit_folds(matrix, spec, n_folds=3).oof.select("Index").distinct().count() == train.where("fold < 3").count()
