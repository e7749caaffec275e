"""Micro-fixtures with hand-computed answers for the scalar rules (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from demandspark.functions import category as cat
from demandspark.functions import metrics, numeric, time
from demandspark.operators.features import base_features, impute_median
from demandspark.operators.order_stats import pct_rank
from demandspark.operators.profile import duplicate_rows, skew_kurtosis


def test_parse_slot(spark):
    df = spark.createDataFrame([("2:15",), ("13:45",), ("7",), ("0:0",)], "timestamp string")
    rows = df.select(time.slot_hour("timestamp").alias("h"), time.slot_minute("timestamp").alias("m")).collect()
    assert [(r.h, r.m) for r in rows] == [(2, 15), (13, 45), (7, 0), (0, 0)]


def test_parse_slot_non_numeric_raises(spark):
    df = spark.createDataFrame([("x",)], "timestamp string")
    with pytest.raises(Exception):
        df.select(time.slot_hour("timestamp")).collect()


def test_flags(spark):
    hours = [22, 23, 0, 4, 5]
    df = spark.createDataFrame([(h,) for h in hours], "hour int")
    assert [r[0] for r in df.select(time.time_flags("hour")["late_night"]).collect()] == [0, 1, 1, 1, 0]
    hours = [6, 7, 9, 10, 17, 19, 20]
    df = spark.createDataFrame([(h,) for h in hours], "hour int")
    assert [r[0] for r in df.select(time.time_flags("hour")["peak_hour"]).collect()] == [0, 1, 1, 0, 1, 1, 0]


def test_temp_band(spark):
    vals = [-100.0, -5.0, 0.0, 0.1, 10.0, 30.0, 31.0, 100.0, 101.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "t double")
    got = [r[0] for r in df.select(numeric.temp_band("t")).collect()]
    assert got == [2.0, 0.0, 0.0, 1.0, 1.0, 3.0, 4.0, 4.0, 2.0, 2.0]


def test_ordinals(spark):
    df = spark.createDataFrame([("Highway",), ("Alley",), ("Unknown",), (None,)], "r string")
    assert [r[0] for r in df.select(cat.road_type_ord("r")).collect()] == [4, 1, 1, 1]
    df = spark.createDataFrame([("Sunny",), ("Windy",), (None,)], "w string")
    assert [r[0] for r in df.select(cat.weather_ord("w")).collect()] == [4, 0, 0]


def test_median_per_frame(spark):
    tr = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0), (None, None)], "NumberofLanes double, Temperature double")
    te = spark.createDataFrame([(10.0, 1.0), (None, None)], "NumberofLanes double, Temperature double")
    assert sorted(r[0] for r in impute_median(tr).collect()) == [1.0, 2.0, 2.0, 4.0]
    assert sorted(r[0] for r in impute_median(te).collect()) == [10.0, 10.0]
    both = tr.withColumn("f", F.lit(0)).unionByName(te.withColumn("f", F.lit(1)))
    got = impute_median(both, frame_col="f", frames=(0, 1))
    assert sorted(r[0] for r in got.where("f = 0").collect()) == [1.0, 2.0, 2.0, 4.0]
    assert sorted(r[0] for r in got.where("f = 1").collect()) == [10.0, 10.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,), (9.0,)], "x double")
    assert [r[0] for r in df.select(numeric.clip("x", 0, 5)).collect()] == [None, 0.0, 2.0, 5.0]


VALS = [0.1, 0.4, 0.4, 0.9, 0.05, 0.7, 0.33]


def test_rank_pct_ties_averaged(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALS)], "i int, v double")
    got = {r.i: r.rk for r in pct_rank(df, "v", "rk").collect()}
    want = [2 / 7, 4.5 / 7, 4.5 / 7, 1.0, 1 / 7, 6 / 7, 3 / 7]
    for i, w in enumerate(want):
        assert got[i] == pytest.approx(w, abs=1e-12)


def test_skew_kurtosis_bias_corrected(spark):
    df = spark.createDataFrame([(v,) for v in VALS], "demand double")
    r = skew_kurtosis(df).first()
    assert r.skewness == pytest.approx(0.5178870348, abs=1e-9)
    assert r.kurtosis == pytest.approx(-0.4942577904, abs=1e-9)


def test_duplicates_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert duplicate_rows(df).first().duplicates == 1


def test_r2_can_be_negative(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 4.5)], "y double, p double")
    assert df.agg(metrics.r2("y", "p")).first()[0] == pytest.approx(-1.125)


def test_hash_fold_is_stable_and_partitions(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "Index")
    a = df.select("Index", metrics.hash_fold("Index").alias("f"))
    b = df.repartition(7).select("Index", metrics.hash_fold("Index").alias("f"))
    assert a.exceptAll(b).count() == 0
    counts = {r.f: r.c for r in a.groupBy("f").agg(F.count("*").alias("c")).collect()}
    assert set(counts) == {0, 1, 2, 3, 4}
    assert min(counts.values()) > 300


def test_base_features_no_python_udf(spark):
    df = spark.createDataFrame([("tdr000", 1, "7:15", 0.1, None, None, None, None, None, None, 1)],
                               "geohash string, day int, timestamp string, demand double, RoadType string, Weather string, "
                               "LargeVehicles string, Landmarks string, NumberofLanes double, Temperature double, Index long")
    out = base_features(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    r = out.first()
    assert (r.hour, r.minute, r.total_minutes, r.morning_peak, r.sin_hour) == (7, 15, 435, 1, pytest.approx(math.sin(2 * math.pi * 7 / 24)))
    assert r.RoadType == "Unknown" and r.road_type_ord == 1 and r.temp_band == 2.0
