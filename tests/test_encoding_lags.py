"""Encodings and lags against brute force on small frames (pandas loops over the definition)."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandspark.operators.encoding import FOLD, EncodingSpec, target_encode
from demandspark.operators.lags import add_reference_day_lags, lag_table
from demandspark.operators.order_stats import exact_quantiles


def _frame(spark, n=300, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = rnd.choice(["a", "b", "c", "d", None]) if i % 37 else "hot"
        rows.append((i, g, rnd.choice([1, 2, 3]), rnd.randrange(5), round(rnd.random(), 4)))
    return spark.createDataFrame(rows, "Index long, g string, h int, fold int, demand double")


def _brute(pdf, keys, agg, oof=True):
    gm = pdf.demand.mean()
    out = {}
    for _, r in pdf.iterrows():
        m = pd.Series(True, index=pdf.index)
        for k in keys:
            m &= (pdf[k] == r[k]) | (pdf[k].isna() & pd.isna(r[k]))
        if oof:
            m &= pdf[FOLD] != r[FOLD]
        s = pdf.loc[m, "demand"]
        v = {"mean": s.mean(), "std": s.std(), "max": s.max(), "median": s.median()}[agg] if len(s) else float("nan")
        out[r.Index] = gm if pd.isna(v) else v
    return out


@pytest.mark.parametrize("keys", [("g",), ("g", "h")])
def test_oof_encoding_matches_definition(spark, keys):
    df = _frame(spark)
    specs = [EncodingSpec(keys, a) for a in ("mean", "std", "max", "median")]
    tr, te, names = target_encode(df, df.drop("demand", FOLD), specs)
    got = tr.select("Index", *names).toPandas().set_index("Index")
    got_te = te.select("Index", *names).toPandas().set_index("Index")
    pdf = df.toPandas()
    for s in specs:
        want = _brute(pdf, keys, s.agg, oof=True)
        want_te = _brute(pdf, keys, s.agg, oof=False)
        for idx, w in want.items():
            assert got.loc[idx, s.name] == pytest.approx(w, abs=1e-12), (s.name, idx)
            assert got_te.loc[idx, s.name] == pytest.approx(want_te[idx], abs=1e-12), (s.name, idx)


def test_std_of_one_row_falls_back_to_global_mean(spark):
    df = spark.createDataFrame([(0, "x", 0, 0.5), (1, "y", 1, 0.1), (2, "y", 2, 0.3)],
                               "Index long, g string, fold int, demand double")
    test = spark.createDataFrame([(9, "x"), (10, "z")], "Index long, g string")
    tr, te, _ = target_encode(df, test, [EncodingSpec(("g",), "std"), EncodingSpec(("g",), "mean")])
    gm = 0.3
    got = {r.Index: (r["te__g__std"], r["te__g__mean"]) for r in te.collect()}
    assert got[9][0] == pytest.approx(gm) and got[9][1] == pytest.approx(0.5)  # one row: std falls back
    assert got[10] == (pytest.approx(gm), pytest.approx(gm))                     # unseen key
    oof = {r.Index: r["te__g__mean"] for r in tr.collect()}
    assert oof[0] == pytest.approx(gm)                                          # only row of its key: held out


def test_exact_quantiles_vs_pandas_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else rnd.choice("abcdef"), rnd.choice([rnd.random(), 0.25, 0.5])) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = exact_quantiles(df, ["g"], "v", {"q10": 0.1, "q50": 0.5, "q75": 0.75}, buckets=8).toPandas().set_index("g")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, s in pdf.groupby("g")["v"]:
        for name, q in (("q10", 0.1), ("q50", 0.5), ("q75", 0.75)):
            assert got.loc[g, name] == pytest.approx(s.quantile(q), abs=1e-12)


def _lag_frames(spark, ref_rows, target_rows):
    cols = "Index long, geohash string, day int, total_minutes int, hour int, demand double"
    return spark.createDataFrame(ref_rows + target_rows, cols)


def test_offset_semantics_and_no_wrap(spark):
    ref = [(1, "c", 29, 60, 1, 0.1), (2, "c", 29, 120, 2, 0.2)]
    tgt = [(3, "c", 30, 60, 1, 0.5), (4, "c", 30, 120, 2, 0.6), (5, "c", 30, 30, 0, 0.7)]
    df = _lag_frames(spark, ref, tgt)
    test = df.filter("day = 30").drop("demand")
    tr, te = add_reference_day_lags(df, test, 29)
    got = {r.Index: r for r in te.collect()}
    assert got[3]["demand_lag_1day_offset_60"] == 0.2     # slot 60 reads reference slot 120
    assert got[4]["demand_lag_1day_offset_m60"] == 0.1    # slot 120 reads reference slot 60
    assert got[5]["demand_lag_1day_offset_m60"] is None   # slot 30 - 60: no wrap to the previous day
    assert got[3]["demand_lag_1day"] == 0.1
    masked = {r.Index: r for r in tr.collect()}
    for c in ["demand_lag_1day", "gh_day48_mean", "demand_lag_1day_offset_60"]:
        assert masked[1][c] is None                       # leak guard on reference-day rows
    assert masked[1]["demand_lag_1day_imputed"] == pytest.approx(0.09394)
    assert masked[3]["demand_lag_1day_imputed"] == 0.1


def test_duplicate_reference_slot_raises(spark):
    ref = [(1, "c", 29, 60, 1, 0.1), (2, "c", 29, 60, 1, 0.2)]
    df = _lag_frames(spark, ref, [])
    with pytest.raises(Exception, match="duplicate"):
        lag_table(df).collect()


def test_encodings_do_not_depend_on_the_join(spark):
    df = _frame(spark)
    specs = [EncodingSpec(("g",), "mean"), EncodingSpec(("g", "h"), "std"), EncodingSpec(("g",), "median")]
    odd = df.withColumn("Index", F.when(F.col("Index") % 2 == 0, F.col("Index")))  # null and repeated row keys
    got = []
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        out, _, names = target_encode(odd, odd.drop("demand", FOLD), specs)
        got.append(sorted(str(tuple(r)) for r in out.select("Index", *names).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] and len(got[0]) == df.count()


def test_std_ignores_a_fold_without_targets(spark):
    rows = [(1, "a", None, 0), (2, "a", 0.1, 1), (3, "a", 0.5, 2), (4, "a", 0.3, 3)]
    df = spark.createDataFrame(rows, f"Index long, g string, demand double, {FOLD} int")
    out, _, names = target_encode(df, df.drop("demand", FOLD), [EncodingSpec(("g",), "std")])
    assert {r["Index"]: round(r[names[0]], 9) for r in out.collect()}[1] == 0.2
