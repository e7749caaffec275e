"""Tasks of the training-data operators give freed memory back: the Python workers that run them live on."""

import os
import re

import numpy as np
import pyarrow as pa
import pytest

from demandspark.llm import bpe, common, decontaminate, exact_dedup, set_join, toxicity


def _held() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="Linux only")
def test_blocks_below_one_in_use_are_given_back(spark):
    def run(batches):
        for b in batches:
            # the C heap keeps blocks under its limit for maps of their own, and all that lie below the last one in use
            blocks = [np.ones(2_000) for _ in range(5_000)]
            run.last = blocks[-1]
            del blocks
            yield b

    def held(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "mb": [_held()]})

    def worker():
        rows = spark.range(4, numPartitions=1).mapInArrow(held, "pid long, mb double").collect()
        return rows[0].pid, rows[0].mb

    spark.range(1, numPartitions=1).mapInArrow(run, "id long").count()
    common.map_batches(spark.range(1, numPartitions=1), run, "id long").count()
    before = worker()
    for _ in range(3):
        assert common.map_batches(spark.range(4, numPartitions=1), run, "id long").count() == 4
        after = worker()
        if after[0] == before[0]:
            assert after[1] < before[1] + 40


def test_memory_is_given_back_when_a_task_is_left_early(monkeypatch):
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    run = common.map_batches(Frame(), lambda rows: iter(rows), "id long")
    assert list(run([1, 2])) == [1, 2] and calls == [1]
    left = run([1, 2])
    next(left)
    left.close()
    assert calls == [1, 1]


def test_all_stages_of_the_pipeline_give_back():
    for module in (bpe, decontaminate, exact_dedup, set_join, toxicity):
        with open(module.__file__) as f:
            assert not re.search(r"\.(mapInArrow|mapInPandas)\(", f.read()), module.__name__
