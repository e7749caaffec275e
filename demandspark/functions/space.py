"""Spatial key columns: hierarchical prefixes of a geohash cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix lengths used as coarser cells.
PREFIX_LENGTHS = (4, 5, 6)


def prefix(col, n: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, n)


def prefixes(col) -> dict[str, Column]:
    out = {f"gh_prefix{n}": prefix(col, n) for n in PREFIX_LENGTHS}
    out["geohash_len"] = F.length(F.col(col) if isinstance(col, str) else col)
    return out
