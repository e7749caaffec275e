"""Ensemble search (grid, exact optimum vs brute force), error queries and the output contract."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from demandspark.operators import ensemble as ens
from demandspark.sources import sinks


def _preds(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.random()
        rows.append((i, y, y + rnd.gauss(0, 0.1), y + rnd.gauss(0.05, 0.2), 0.5 * y + rnd.gauss(0, 0.05)))
    return spark.createDataFrame(rows, "Index long, demand double, p1 double, p2 double, p3 double"), rows


def _r2(rows, w):
    ys = [r[1] for r in rows]
    mean = sum(ys) / len(ys)
    ss_tot = sum((y - mean) ** 2 for y in ys)
    ss_res = sum((r[1] - (w[0] * r[2] + w[1] * r[3] + w[2] * r[4])) ** 2 for r in rows)
    return 1 - ss_res / ss_tot


def test_grid_has_231_points_and_scores_match(spark):
    df, rows = _preds(spark)
    g = ens.grid(ens.gram_stats(df, "demand")).collect()
    assert len(g) == 231
    for r in g[::17]:
        assert r.w1 + r.w2 + r.w3 == pytest.approx(1.0)
        assert r.r2 == pytest.approx(_r2(rows, (r.w1, r.w2, r.w3)), abs=1e-9)


def test_grid_tie_rule_identical_predictors(spark):
    df = spark.createDataFrame([(0, 1.0, 1.1, 1.1, 1.1), (1, 2.0, 1.9, 1.9, 1.9), (2, 3.0, 3.2, 3.2, 3.2)],
                               "Index long, demand double, p1 double, p2 double, p3 double")
    best = ens.grid_best(ens.grid(ens.gram_stats(df, "demand"))).first()
    assert (best.w1, best.w2, best.w3) == (1.0, 0.0, 0.0)


def test_optimal_weights_beat_grid_and_match_brute_force(spark):
    df, rows = _preds(spark)
    stats = ens.gram_stats(df, "demand")
    opt = ens.optimal_weights(stats).first()
    best = ens.grid_best(ens.grid(stats)).first()
    assert opt.r2 >= best.r2 - 1e-12
    assert opt.w1 >= 0 and opt.w2 >= 0 and opt.w3 >= 0 and opt.w1 + opt.w2 + opt.w3 == pytest.approx(1.0)
    assert opt.r2 == pytest.approx(_r2(rows, (opt.w1, opt.w2, opt.w3)), abs=1e-9)
    step = 0.01
    fine = max(_r2(rows, (a * step, b * step, 1 - (a + b) * step))
               for a, b in itertools.product(range(101), range(101)) if a + b <= 100)
    assert opt.r2 >= fine - 1e-9


def test_contract_raises_on_null_and_lost_row(spark):
    inputs = spark.createDataFrame([(1,), (2,), (3,)], "Index long")
    good = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3)], "Index long, demand double")
    assert sinks.check_contract(good, inputs, expected_rows=3)["rows"] == 3
    with pytest.raises(sinks.ContractError):
        sinks.check_contract(spark.createDataFrame([(1, 0.1), (2, None), (3, 0.3)], "Index long, demand double"), inputs)
    with pytest.raises(sinks.ContractError):
        sinks.check_contract(spark.createDataFrame([(1, 0.1), (2, 0.2)], "Index long, demand double"), inputs)


def test_write_submission_csv(spark, tmp_path):
    inputs = spark.createDataFrame([(1,), (2,)], "Index long")
    sub = spark.createDataFrame([(1, 0.1), (2, 0.2)], "Index long, demand double")
    out = str(tmp_path / "submission")
    sinks.write_submission(sub, out, inputs=inputs, expected_rows=2)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["Index", "demand"] and back.count() == 2


def test_undefined_scores_are_null_and_equal_predictors_do_not_fail(spark):
    from demandspark.functions.metrics import r2
    from demandspark.operators import ensemble as ens
    same = spark.createDataFrame([(0.5, 0.4), (0.5, 0.6)], "y double, p double")
    assert same.agg(r2("y", "p").alias("r")).first()["r"] is None
    rows = [(i / 10, i / 12, i / 12, i / 12) for i in range(8)]
    df = spark.createDataFrame(rows, "demand double, p1 double, p2 double, p3 double")
    best = ens.optimal_weights(ens.gram_stats(df, "demand")).first()
    assert abs(best["w1"] + best["w2"] + best["w3"] - 1) < 1e-9 and best["r2"] > 0.9
