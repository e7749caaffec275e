"""Catalog queries against their DuckDB oracle on the smallest data folder, the entry point, streaming."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

FAST = ["scan_train", "aud_missing_pct", "aud_duplicates", "aud_describe_target", "aud_slot_overlap",
        "feat_num_band", "feat_cat_ordinal", "lag_offsets", "lag_mask", "enc_frequency", "te_oof_std",
        "te_oof_median", "dom_rank_pct", "ens_grid_best", "err_worst_cells", "stream_panel", "join_day_pairs", "ens_weights", "ens_fold_summary"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(srows, df.columns) == _rows(drows, dcols)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "te__geohash__mean" in df.columns and df.count() > 0
