"""Readers: CSV with a declared schema (header, no inference) and parquet tables of a data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.sources.schemas import ROW_KEY, TEST_SCHEMA, TRAIN_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV scan with an explicit schema; malformed values fail the job instead of becoming null."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value everywhere in this library, so it becomes null where data come in."""
    return df.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def _with_index(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file without the row key gets one from its values: the same in every run, and equal for equal rows."""
    header = spark.read.option("header", True).csv(path).columns
    if ROW_KEY in header:
        return nan_to_null(read_csv(spark, path, schema))
    df = nan_to_null(read_csv(spark, path, T.StructType([f for f in schema.fields if f.name != ROW_KEY])))
    key = F.xxhash64(*df.columns).cast(schema[ROW_KEY].dataType)
    return df.withColumn(ROW_KEY, key).select(*[f.name for f in schema.fields])


def read_train_csv(spark: SparkSession, path: str) -> DataFrame:
    return _with_index(spark, path, TRAIN_SCHEMA)


def read_test_csv(spark: SparkSession, path: str) -> DataFrame:
    return _with_index(spark, path, TEST_SCHEMA)


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of a data folder: ``<dir>/<name>.parquet`` (file or folder of parts)."""
    return nan_to_null(spark.read.parquet(os.path.join(data_dir, f"{name}.parquet")))
