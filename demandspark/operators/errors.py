"""Error analysis of out-of-fold predictions: residual columns and grouped / thresholded summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import clip
from demandspark.sources.schemas import TARGET

# Error thresholds and report sizes.
HIGH_ERROR = 0.10
UNDER_PRED = 0.05
OVER_PRED = -0.05
WORST_N = 10
MAE_DIGITS = 5


def residuals(df: DataFrame, pred: str, target: str = TARGET) -> DataFrame:
    """``oof_pred`` (prediction clipped to [0, 1]), ``residual`` = target - oof_pred, ``abs_err``."""
    df = df.withColumn("oof_pred", clip(pred, 0.0, 1.0))
    df = df.withColumn("residual", F.col(target) - F.col("oof_pred"))
    return df.withColumn("abs_err", F.abs("residual"))


def worst_cells(df: DataFrame, cell: str = "geohash", n: int = WORST_N) -> DataFrame:
    """Top ``n`` cells by mean absolute error with their row count (ties broken by cell)."""
    return (df.groupBy(cell).agg(F.avg("abs_err").alias("mae"), F.count("abs_err").alias("n"))
            .orderBy(F.col("mae").desc(), F.col(cell).asc()).limit(n))


def mae_by(df: DataFrame, col: str = "hour", digits: int = MAE_DIGITS) -> DataFrame:
    return df.groupBy(col).agg(F.round(F.avg("abs_err"), digits).alias("mae")).orderBy(col)


def threshold_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("abs_err") > HIGH_ERROR).alias("high_error"),
                  F.count_if(F.col("residual") > UNDER_PRED).alias("under_predicted"),
                  F.count_if(F.col("residual") < OVER_PRED).alias("over_predicted"))


def high_error_by(df: DataFrame, col: str = "RoadType") -> DataFrame:
    """Value counts of ``col`` among rows with |error| > 0.10, descending (null category not counted)."""
    return (df.filter((F.col("abs_err") > HIGH_ERROR) & F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc()))
