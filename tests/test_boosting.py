"""Boosting with patience, cut models, out-of-fold fits, gain importances, ordered categoricals, stacks and contracts."""

import dataclasses
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from demandspark.functions.metrics import r2
from demandspark.operators import boosting as boo
from demandspark.operators import cv
from demandspark.operators import ensemble as ens
from demandspark.operators.encoding import FOLD
from demandspark.sources import sinks

SMALL = boo.BoostingConfig(rounds=40, patience=3, step=0.3, depth=2, min_rows=5, bins=32, first=4)


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    r = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = r.random(), r.random(), r.choice("uvw")
        rows.append((i, i % 5, a, b, r.random(), c, (a > 0.5) + 0.5 * (b > 0.3) * (a > 0.2) + (c == "u") + r.gauss(0, 0.3)))
    path = str(tmp_path_factory.mktemp("boost"))
    df = spark.createDataFrame(rows, "Index long, fold int, a double, b double, noise double, c string, demand double")
    df.write.parquet(f"{path}/train")
    df.limit(50).select(F.col("Index") + 1000, "a", "b", "noise", F.lit("new").alias("c")).toDF("Index", "a", "b", "noise", "c").write.parquet(f"{path}/test")
    return spark.read.parquet(f"{path}/train"), spark.read.parquet(f"{path}/test")


@pytest.fixture(scope="module")
def vectors(frames):
    return VectorAssembler(inputCols=["a", "b", "noise"], outputCol="features").transform(frames[0])


def test_best_round_on_a_curve_with_a_bump():
    curve = [5.0, 4.0, 4.2, 4.3, 3.5, 3.6, 3.5, 3.8]
    assert boo.best_round(curve, 2) == (2, True)
    assert boo.best_round(curve, 3) == (5, True)
    assert boo.best_round(curve, 4) == (5, False)
    assert boo.best_round([1.0], 1) == (1, False) and boo.best_round([float("nan"), 2.0, 3.0], 1) == (2, True)


def test_cut_is_the_lowest_loss(vectors):
    rows, held = vectors.where("fold <> 0"), vectors.where("fold = 0")
    model, losses = boo.boost(SMALL, rows, held)
    keep, ended = boo.best_round(losses, SMALL.patience)
    assert model.getNumTrees == keep > 1 and ended and losses[keep - 1] == min(losses[: keep + SMALL.patience])
    mse = model.transform(held).agg(F.avg((F.col("demand") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(losses[keep - 1])
    # grown at once or by doubling: the same model
    other, _ = boo.boost(dataclasses.replace(SMALL, first=40), rows, held)
    assert other.getNumTrees == keep and other.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_held_rows_choose_rounds_only(vectors):
    rows, held = vectors.where("fold <> 0"), vectors.where("fold = 0")
    other = held.withColumn("demand", F.lit(9.0) - F.col("demand"))
    a, _ = boo.boost(SMALL, rows, held)
    b, _ = boo.boost(SMALL, rows, other)
    n = min(a.getNumTrees, b.getNumTrees)
    assert boo.cut(a, n).toDebugString.split("\n", 1)[1] == boo.cut(b, n).toDebugString.split("\n", 1)[1]
    none, losses = boo.boost(dataclasses.replace(SMALL, rounds=3), rows, held.where("false"))
    assert none.getNumTrees == 3 and losses == []


def test_fold_fits_share_one_matrix(spark, frames):
    train, test = frames
    specs = [cv.LearnerSpec("both", SMALL, ("a", "b", "noise"), ("c",)), cv.LearnerSpec("plain", SMALL, ("b", "a"))]
    matrix = cv.assemble(train, test, specs)
    assert matrix.columns == ["a", "b", "noise", "c"] and matrix.rows.count() == 450
    found = [cv.fit_folds(matrix, s, parallelism=2) for s in specs]
    for res in found:
        oof = res.oof.collect()
        assert sorted(r.Index for r in oof) == list(range(400)) and all(r[FOLD] == r.Index % 5 for r in oof)
        assert res.test.groupBy("Index").count().where("count <> 5").count() == 0
        assert all(n > 1 for n in res.rounds)
        scores = cv.fold_scores(res.oof, train).collect()
        assert len(scores) == 5 and min(r.r2 for r in scores) > 0.2
        assert cv.score_summary(res.oof, train).first().oof_r2 == pytest.approx(
            res.oof.join(train, "Index").agg(r2("demand", "prediction")).first()[0])
    assert cv.test_mean(found[0].test).count() == 50
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    top = {r.feature: r.importance for r in cv.importances(found[0]).collect()}
    assert set(top) == {"a", "b", "noise", "c"} and top["a"] > top["noise"]


def test_gains_are_added_up_and_not_normalised(spark):
    nodes = spark.createDataFrame([(0, 0, 1, 4.0), (0, 1, None, -1.0), (0, 2, 0, 0.5), (1, 0, 1, 2.0), (1, 1, 0, 0.0)],
                                  "tree int, node int, feature int, gain double")
    got = [tuple(r) for r in boo.gain_importances(nodes, ["x", "y", "z"]).collect()]
    assert got == [("y", 6.0), ("x", 0.5), ("z", 0.0)]


def test_node_table_of_a_known_tree(spark):
    df = spark.createDataFrame([(float(i), 0.0 if i < 6 else 10.0) for i in range(12)], "x double, demand double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = boo.BoostingConfig(rounds=1, patience=1, step=0.1, depth=1).estimator(1).fit(df)
    rows = boo.node_table(model).orderBy("node").collect()
    assert [(r.tree, r.feature) for r in rows] == [(0, 0), (0, None), (0, None)]
    assert rows[0].gain == pytest.approx(25.0)  # the variance that the split takes away


def test_cells_ordered_by_target(spark):
    r = random.Random(6)
    rows = [(i, r.randrange(5), f"cell{i % 1200}", (i % 1200) / 1200 + r.gauss(0, 0.01)) for i in range(4800)]
    train = spark.createDataFrame(rows, "Index long, fold int, cell string, demand double")
    test = spark.createDataFrame([(9001, "cell7"), (9002, "never seen"), (9003, None)], "Index long, cell string")
    tr, te, names = cv.order_categories(train, test, ["cell"])
    assert names == ["te__cell__smooth"] and tr.count() == 4800 and tr.where(f"{names[0]} is null").count() == 0
    got = {x.Index: x[names[0]] for x in te.collect()}
    mean = sum(x[3] for x in rows) / len(rows)
    seven = [x[3] for x in rows if x[2] == "cell7"]
    assert got[9001] == pytest.approx((sum(seven) + mean) / (len(seven) + 1)) and got[9002] == got[9003] == pytest.approx(mean)
    config = boo.BoostingConfig(rounds=30, patience=2, step=0.5, depth=4, bins=64)
    spec = cv.LearnerSpec("cells", config, tuple(names))
    res = cv.fit_folds(cv.assemble(tr, te, [spec]), spec, n_folds=5, parallelism=2)
    assert cv.score_summary(res.oof, train).first().oof_r2 > 0.9


def test_a_stack_has_every_key_and_learner_once(spark):
    schema = "Index long, learner string, prediction double"
    good = [(1, "p", 0.1), (1, "q", 0.2), (2, "q", 0.4), (2, "p", None)]
    keys = spark.createDataFrame([(1, 0.5), (2, 0.6)], "Index long, demand double")
    got = sorted(tuple(r) for r in ens.stack(spark.createDataFrame(good, schema), ["p", "q"], keys).collect())
    assert got == [(1, 0.5, 0.1, 0.2), (2, 0.6, None, 0.4)]
    wrong = [good + [(2, "p", 0.3)], good[:3], good + [(3, "p", 0.1), (3, "q", 0.1)], good + [(1, "other", 0.1)], good[:2]]
    for rows in wrong:
        with pytest.raises(Exception, match="one prediction of each learner"):
            ens.stack(spark.createDataFrame(rows, schema), ["p", "q"], keys).collect()
    with pytest.raises(Exception, match="one prediction of each learner"):
        ens.stack(spark.createDataFrame(good, schema), ["p", "q"], keys.union(keys.limit(1))).collect()


def test_a_breach_of_the_contract_leaves_the_output_as_it_was(spark, tmp_path):
    sample = spark.createDataFrame([(1, 0.0), (2, 0.0)], "Index long, demand double")
    good = spark.createDataFrame([(1, 0.1), (2, 0.2)], "Index long, demand double")
    out = str(tmp_path / "out")
    sinks.write_submission(good, out, inputs=sample, expected_rows=2)
    bad = {"null": [(1, 0.1), (2, None)], "missing": [(1, 0.1)], "sample": [(1, 0.1), (2, 0.2), (3, 0.3)], "count": [(1, 0.1), (2, 0.2), (2, 0.2)]}
    for word, rows in bad.items():
        with pytest.raises(sinks.ContractError, match=word):
            sinks.write_submission(spark.createDataFrame(rows, "Index long, demand double"), out, inputs=sample)
    with pytest.raises(sinks.ContractError, match="count"):
        sinks.write_submission(good, out, inputs=sample, expected_rows=3)
    assert spark.read.option("header", True).csv(out).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    fresh = str(tmp_path / "fresh")
    with pytest.raises(sinks.ContractError):
        sinks.write_submission(good.limit(1), fresh, inputs=sample)
    assert not (tmp_path / "fresh").exists()
