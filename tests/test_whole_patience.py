"""The registered model queries train with the learners' own rounds and patience."""

from types import SimpleNamespace

import pytest

from demandspark.plans import modeling


class _Seen(Exception):
    pass


def _seen(monkeypatch, query):
    frame = SimpleNamespace(select=lambda *a: None)
    monkeypatch.setattr(modeling, "session_id", lambda s: "none")
    monkeypatch.setattr(modeling, "data_state", lambda s, d: ())
    monkeypatch.setattr(modeling, "build_features", lambda *a, **k: SimpleNamespace(train=frame, test=frame))
    monkeypatch.setattr(modeling, "feature_matrix", lambda *a, **k: None)
    monkeypatch.setattr(modeling, "cut_lineage", lambda df: df)
    monkeypatch.setattr(modeling.cv, "order_categories", lambda train, test, cats: (train, test, []))

    def stop(train, test, specs):
        raise _Seen([s.config for s in specs])

    monkeypatch.setattr(modeling.cv, "assemble", stop)
    with pytest.raises(_Seen) as found:
        modeling.MODEL_QUERIES[query](None, "no such folder")
    return [(c.rounds, c.patience, c.first) for c in found.value.args[0]]


@pytest.mark.parametrize("query", [q for q in modeling.MODEL_QUERIES if q != "cv_v1_oof_predictions"])
def test_queries_wait_as_long_as_their_learners(monkeypatch, query):
    assert _seen(monkeypatch, query) == [(2500, 150, None), (5000, 200, None), (5000, 200, None)]


def test_the_first_version_waits_as_long_as_its_learner(monkeypatch):
    assert _seen(monkeypatch, "cv_v1_oof_predictions") == [(4000, 200, None)]
