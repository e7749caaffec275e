"""Declared schemas of the labelled frame, the unlabelled frame and the submission (no type inference)."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET = "demand"
ROW_KEY = "Index"

_COMMON = [
    T.StructField("geohash", T.StringType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("RoadType", T.StringType(), True),
    T.StructField("NumberofLanes", T.DoubleType(), True),
    T.StructField("LargeVehicles", T.StringType(), True),
    T.StructField("Landmarks", T.StringType(), True),
    T.StructField("Temperature", T.DoubleType(), True),
    T.StructField("Weather", T.StringType(), True),
]

TRAIN_SCHEMA = T.StructType([T.StructField(ROW_KEY, T.LongType(), True)] + _COMMON
                            + [T.StructField(TARGET, T.DoubleType(), True)])
TEST_SCHEMA = T.StructType([T.StructField(ROW_KEY, T.LongType(), True)] + _COMMON)
