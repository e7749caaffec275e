"""Feature-matrix assembly: the numeric feature list, categoricals, the -999 sentinel and vector assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.category import CATEGORICAL_COLS
from demandspark.operators.encoding import ENCODING_SPECS
from demandspark.operators.lags import IMPUTED, LAG, OFFSETS, offset_name, stat_names
from demandspark.sources.schemas import ROW_KEY, TARGET

# Base numeric features in their reference order (v1 has the first 40, v2 all 42).
BASE_NUM = [
    "hour", "minute", "total_minutes",
    "peak_hour", "morning_peak", "evening_peak", "late_night", "midday",
    "sin_hour", "cos_hour", "sin_minute", "cos_minute", "sin_total", "cos_total",
    "day",
    "NumberofLanes", "large_veh_bin", "landmarks_bin",
    "road_type_ord", "weather_ord",
    "Temperature", "temp_extreme", "temp_band",
    "road_capacity", "road_capacity2", "congestion_potential",
    "geohash_len", "geohash_freq", "gh_prefix4_freq", "gh_prefix5_freq",
    "lane_pressure", "landmark_congestion", "weather_sensitivity",
    "congestion_score", "gh_cv", "gh_rank",
    "road_x_hour", "lanes_x_hour", "lanes_x_peak", "road_x_weather",
    "lane_pressure_lag", "congestion_potential_lag",
]
V1_BASE_NUM = BASE_NUM[:40]
LAG_NUM = [LAG, IMPUTED] + stat_names() + [offset_name(o) for o in OFFSETS]
# Categoricals given to the categorical-aware learner (v1 adds the cell and its prefixes).
V2_CAT = list(CATEGORICAL_COLS)
V1_CAT = ["geohash", "gh_prefix4", "gh_prefix5", "gh_prefix6", "RoadType", "Weather", "LargeVehicles", "Landmarks"]
SENTINEL = -999.0


def numeric_features(version: int = 2) -> list[str]:
    te = [s.name for s in ENCODING_SPECS]
    return (BASE_NUM + LAG_NUM + te) if version == 2 else (V1_BASE_NUM + te)


def categorical_features(version: int = 2) -> list[str]:
    return V2_CAT if version == 2 else V1_CAT


def feature_matrix(df: DataFrame, version: int = 2, with_target: bool = True, extra=(ROW_KEY,)) -> DataFrame:
    """Row key, numeric features as double with nulls → -999, categoricals as strings, target if present."""
    num = [F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)).alias(c) for c in numeric_features(version)]
    cat = [F.coalesce(F.col(c).cast("string"), F.lit(str(int(SENTINEL)))).alias(c) for c in categorical_features(version)]
    tail = [F.col(TARGET)] if with_target and TARGET in df.columns else []
    return df.select(*[F.col(c) for c in extra if c in df.columns], *num, *cat, *tail)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
