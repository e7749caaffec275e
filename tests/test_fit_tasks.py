"""A fit has as many tasks as its rows are worth, and a learner's other folds do not wait for other learners."""

import time

from demandspark.operators import cv
from tests.test_fold_growth import _rows, boo


def test_tasks_grow_with_the_matrix():
    assert cv.fit_tasks(88_000, 97) == 0 and cv.fit_tasks(527_742, 97) == 3 and cv.fit_tasks(5_277_420, 97) == 30


def test_small_parts_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(cv, "TASK_VALUES", 200)
    train = _rows(spark).repartition(7)
    spec = cv.LearnerSpec("x", boo.BoostingConfig(rounds=2, patience=1, step=0.1, depth=1, bins=32), ("a", "b"))
    matrix = cv.assemble(train, train.limit(5).drop("fold", "demand"), [spec])
    assert matrix.tasks == 305 * 2 // 200 == 3
    matrix = cv.Matrix(matrix.rows.repartition(7), matrix.columns, matrix.tasks)
    seen, boost = [], cv.boost
    monkeypatch.setattr(cv, "boost", lambda c, rows, held, f: (seen.append((f, rows.rdd.getNumPartitions(), rows.count())), boost(c, rows, held, f))[1])
    found = cv.fit_folds(matrix, spec, n_folds=3)
    assert sorted(seen) == [(0, 3, 200), (1, 3, 200), (2, 3, 200)] and found.oof.count() == 300


def test_folds_begin_when_their_own_first_fold_ends(spark, monkeypatch):
    train = _rows(spark)
    specs = [cv.LearnerSpec(n, boo.BoostingConfig(rounds=1, patience=1, step=s, depth=1, bins=32), ("a", "b")) for n, s in (("quick", 0.1), ("slow", 0.2))]
    matrix = cv.assemble(train, train.limit(5).drop("fold", "demand"), specs)
    order, boost = [], cv.boost

    def slow(config, rows, held, f):
        out = boost(config, rows, held, f)
        until = time.time() + 60
        while config.step == 0.2 and f == 0 and ("quick", 2) not in order and time.time() < until:
            time.sleep(0.05)
        order.append(("quick" if config.step == 0.1 else "slow", f))
        return out

    monkeypatch.setattr(cv, "boost", slow)
    cv.fit_learners(matrix, specs, n_folds=3, parallelism=2)
    assert order.index(("quick", 2)) < order.index(("slow", 0)) and len(order) == 6
