"""Numeric column helpers: null-preserving clip, right-closed banding, extremes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clip(col, lo: float, hi: float) -> Column:
    """Clip to [lo, hi] keeping null (``least``/``greatest`` alone would turn null into a bound)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


# Temperature band edges (right-closed) and the band given to values outside them.
TEMP_BAND_EDGES = [-100.0, 0.0, 10.0, 20.0, 30.0, 100.0]
TEMP_BAND_DEFAULT = 2.0
TEMP_EXTREME_HIGH = 35.0
TEMP_EXTREME_LOW = 0.0


def right_closed_band(col, edges: list[float], default: float) -> Column:
    """Index of the interval (edges[i], edges[i+1]] holding the value, as double; outside or null → default."""
    c = _c(col)
    expr = None
    for i in range(len(edges) - 1):
        cond = (c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return expr.otherwise(F.lit(float(default)))


def temp_band(col) -> Column:
    return right_closed_band(col, TEMP_BAND_EDGES, TEMP_BAND_DEFAULT)


def temp_extreme(col) -> Column:
    c = _c(col)
    return F.coalesce((c > TEMP_EXTREME_HIGH) | (c < TEMP_EXTREME_LOW), F.lit(False)).cast("int")
