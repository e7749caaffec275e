"""Operator 1 looks at its texts in small steps: the temporaries of a step are many times its text."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from demandspark.llm import decontaminate as dec


def _words(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice([f"{a}{b}" for a in "bcdfgklm" for b in "aeiou"], n))


def _finder(items: list[str]):
    made = [x for i, t in enumerate(items) for x in dec.make_items(i, t, 12, 100, 0.05)]
    indexes = [dec.Index([x for x in made if x.q == size], size) for size in sorted({x.q for x in made})]
    session = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
    return dec._finder(SimpleNamespace(sparkSession=session), indexes)


def test_a_step_takes_little_memory_and_loses_no_passage():
    passage = _words(1, 60)
    texts = [_words(s, 4_000) for s in range(2, 202)]
    for at in (0, 57, 199):
        texts[at] = f"{texts[at][:5_000]} {passage} {texts[at][5_000:]}"
    batch = pa.RecordBatch.from_pydict({"row": list(range(200)), "doc_id": list(range(200)), "text": texts})
    run = _finder([passage])
    tracemalloc.start()
    try:
        found = [r for b in run(iter([batch])) for r in b.column("row").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert found == [0, 57, 199]
    assert peak < 16, peak


def test_the_pipeline_filters_in_these_steps(spark):
    passage = _words(1, 60)
    texts = [_words(s, 8_000) for s in range(2, 32)]
    texts[3] += passage
    texts[17] = passage + texts[17]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    kept = dec.drop_leaks(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(30) if i not in (3, 17)]
