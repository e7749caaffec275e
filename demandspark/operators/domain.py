"""Domain features derived from the encodings and the imputed lag (one projection + one rank join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import clip
from demandspark.operators.encoding import FOLD
from demandspark.operators.lags import IMPUTED
from demandspark.operators.order_stats import pct_rank

GH_MEAN = "te__geohash__mean"
GH_STD = "te__geohash__std"
GH_HOUR = "te__geohash__hour__mean"
GH_WEATHER = "te__geohash__Weather__mean"

# Ratio guards, clip bounds and weights of the composite scores.
LANES_EPS = 1e-6
MEAN_EPS = 1e-9
WEATHER_SENS_MAX = 5.0
CV_MAX = 10.0


def encoding_features(df: DataFrame) -> DataFrame:
    lanes = F.col("NumberofLanes")
    df = df.withColumns({
        "lane_pressure": F.col(GH_MEAN) / (lanes + F.lit(LANES_EPS)),
        "landmark_congestion": F.col("landmarks_bin") * F.col(GH_HOUR) * (F.lit(1) + F.col("peak_hour")),
        "weather_sensitivity": clip(F.col(GH_WEATHER) / (F.col(GH_MEAN) + F.lit(MEAN_EPS)), 0.0, WEATHER_SENS_MAX),
    })
    return df.withColumns({
        "congestion_score": (F.col(GH_HOUR) * 0.40 + F.col("lane_pressure") * 0.30
                             + F.col("landmark_congestion") * 0.20 + F.col("congestion_potential") * 0.10),
        "gh_cv": clip(F.col(GH_STD) / (F.col(GH_MEAN) + F.lit(MEAN_EPS)), 0.0, CV_MAX),
    })


def rank_feature(df: DataFrame, frame_col: str | None = None) -> DataFrame:
    """``gh_rank``: tie-averaged percentile rank of the cell-mean encoding within this frame (within each
    ``frame_col`` value when frames are stacked). The encoding is one value for each cell and fold, so the rank is
    found for those and looked up by them."""
    keys = [c for c in ("geohash", FOLD) if c in df.columns]
    return pct_rank(df, GH_MEAN, "gh_rank", group_cols=[frame_col] if frame_col else None, key_cols=keys)


def lag_features(df: DataFrame) -> DataFrame:
    lanes, lag = F.col("NumberofLanes"), F.col(IMPUTED)
    return df.withColumns({
        "lane_pressure_lag": lag / (lanes + F.lit(LANES_EPS)),
        "congestion_potential_lag": (F.col("road_type_ord") * 0.3 + lanes * 0.2 + lag * 0.4
                                     + F.col("peak_hour") * 0.1),
    })


def domain_features(df: DataFrame, with_lags: bool = True, frame_col: str | None = None) -> DataFrame:
    df = rank_feature(encoding_features(df), frame_col)
    return lag_features(df) if with_lags else df
