"""Operator 4 gives freed memory back after every group and task: the Python workers that run them live on."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandspark.llm import common, lm_score


def test_memory_is_given_back_after_each_group(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    rows = pa.table({"id": [1, 2]})
    assert common.by_group(lambda t: t)(rows) is rows and calls == [1]
    assert common.by_cogroup(lambda a, b: b)(None, rows) is rows and calls == [1, 1]
    with pytest.raises(ZeroDivisionError):
        common.by_group(lambda t: 1 / 0)(rows)
    assert calls == [1, 1, 1]


def test_operator_4_gives_back_everywhere():
    with open(lm_score.__file__) as f:
        code = f.read()
    assert not re.search(r"\.(mapInArrow|mapInPandas)\(", code)
    assert code.count("applyInArrow(") == len(re.findall(r"applyInArrow\(\s*by_(?:co)?group\(", code)) == 3


def test_losses_are_as_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, None), (3, "A")], "doc_id long, text string")
    got = {(r.doc_id, r.n_tokens): r.background_loss for r in lm_score.score_documents(docs, F.col("doc_id") == 1).collect()}
    assert set(got) == {(1, 3), (2, 1), (3, 0), (3, 1)} and got[3, 0] == 0
    # words: a 3, b 2 of 5 in all, 2 distinct; starts 3; pairs: start-a 2, start-b 1
    a, b = (3 + 1) / 7, (2 + 1) / 7
    assert got[3, 1] == pytest.approx(-lm_score.np.log((2 + 4 * a) / (3 + 4)))
    assert got[2, 1] == pytest.approx(-lm_score.np.log((1 + 4 * b) / (3 + 4)))
