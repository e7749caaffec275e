"""Categorical columns: constant fill, ordinal maps with defaults, binary indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fill label, ordinal maps and their defaults for non-null unmapped labels.
UNKNOWN = "Unknown"
CATEGORICAL_COLS = ["RoadType", "Weather", "LargeVehicles", "Landmarks"]
ROAD_TYPE_ORDINAL = {"Highway": 4, "Street": 3, "Residential": 2, "Unknown": 1}
ROAD_TYPE_DEFAULT = 1
WEATHER_ORDINAL = {"Sunny": 4, "Foggy": 3, "Rainy": 2, "Snowy": 1, "Unknown": 0}
WEATHER_DEFAULT = 0
LARGE_VEHICLES_POSITIVE = "Allowed"
LANDMARKS_POSITIVE = "Yes"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fill_unknown(col) -> Column:
    return F.coalesce(_c(col), F.lit(UNKNOWN))


def ordinal(col, mapping: dict[str, int], default: int) -> Column:
    """CASE chain (codegen-friendly, no map literal); unmapped or null labels take ``default``."""
    c = _c(col)
    expr = None
    for label, code in mapping.items():
        expr = F.when(c == label, F.lit(code)) if expr is None else expr.when(c == label, F.lit(code))
    return expr.otherwise(F.lit(default)).cast("int")


def road_type_ord(col) -> Column:
    return ordinal(col, ROAD_TYPE_ORDINAL, ROAD_TYPE_DEFAULT)


def weather_ord(col) -> Column:
    return ordinal(col, WEATHER_ORDINAL, WEATHER_DEFAULT)


def indicator(col, positive: str) -> Column:
    """1 when equal to ``positive``; null compares false (the column is filled before in practice)."""
    return F.coalesce(_c(col) == positive, F.lit(False)).cast("int")
