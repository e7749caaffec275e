"""Two sets meet in the list of the first n-gram that they share, not in every list that has both."""

import random

import pytest

from demandspark.llm import set_join
from tests.llm.test_operators import brute_components, edited, prose


def _families(families, members, words, edits):
    """Texts with ``edits`` words changed at random: few of a family link, but all share most of their n-grams."""
    r, rows = random.Random(11), []
    for f in range(families):
        base = prose(700 + f, words)
        for _ in range(members):
            t = base
            for at in r.sample(range(words), r.choice(edits)):
                t = edited(t, at, f"n{r.randrange(10 ** 6)}")
            rows.append((len(rows), t))
    return rows


@pytest.mark.parametrize("counters", [1, 1 << 12])
def test_pairs_meet_once(spark, tmp_path, monkeypatch, counters):
    rows = _families(3, 16, 150, (1, 3, 4, 5))
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    saved, save = {}, set_join.save

    def counted(df, label):
        out = save(df, label)
        saved[label] = out.count() if label in ("join-open", "join-pairs") else 0
        return out

    monkeypatch.setattr(set_join, "save", counted)
    found = set_join.similar_documents(spark.read.parquet(str(tmp_path / "d")), counters=counters).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in found) == sorted(brute_components(rows))
    assert saved["join-open"] <= 2 * max(saved["join-pairs"], 1)  # before, several times as many: a pair in each list it shares
    if counters == 1:  # all n-grams count alike, so that the lists hold many of the shared ones
        assert saved["join-pairs"] > 100


def test_earlier_entries_of_a_set(spark):
    rows = [(10 + p, s, 9, p) for s in (1, 2) for p in (0, 2, 3, 5, 7, 8)]
    found = {(r.set, r.pos): r.earlier for r in set_join.with_earlier(
        spark.createDataFrame(rows, "token bigint, set bigint, n_shingles bigint, pos bigint")).collect()}
    assert found[1, 0] == [None] * 4 and found[2, 3] == [12, 10, None, None] and found[1, 8] == [17, 15, 13, 12]
