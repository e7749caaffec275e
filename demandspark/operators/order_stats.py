"""Exact order statistics without sending a group to one task.

Both exact quantiles (linear interpolation) and tie-averaged percentile ranks need, for every distinct value,
the total weight of the smaller values of its group. A window ordered over the whole group would put the
group — possibly a third of all rows — into one task. Instead:

1. ``histogram``: (group, value) → weight. Partial aggregation, so hot groups are combined map-side and
   repeated values collapse.
2. ``prefix_weights``: the histogram is range-partitioned by (group, value), into as many partitions as its size
   asks for, and saved with the partition's number. A first pass totals the weights of each (group, partition); their
   prefix sums are over one number for each partition. A second pass runs inside each partition. A hot group is thus
   spread over all partitions that its distinct values fill, and the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.session import cut_lineage


def _cols(group_cols) -> list[str]:
    if group_cols is None:
        return []
    return [group_cols] if isinstance(group_cols, str) else list(group_cols)


def _join_null_safe(left: DataFrame, right: DataFrame, cols, how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where null keys match (a null group is a group), keeping one copy of each key."""
    r = right.select(*[F.col(c).alias(f"_j_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = [F.col(c).eqNullSafe(F.col(f"_j_{c}")) for c in cols]
    return left.join(r, cond, how).drop(*[f"_j_{c}" for c in cols])


def histogram(df: DataFrame, group_cols, value_col: str, weight_col: str | None = None) -> DataFrame:
    """(group..., value, _w): total weight per distinct non-null value."""
    g = _cols(group_cols)
    w = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    return (df.filter(F.col(value_col).isNotNull())
            .groupBy(*g, value_col).agg(w.cast("long").alias("_w")))


def prefix_weights(hist: DataFrame, group_cols, value_col: str, buckets: int | None = None) -> DataFrame:
    """Adds ``_before`` (weight of strictly smaller values in the group) and ``_n`` (group total weight).

    ``buckets``: number of ranges; by default as many shuffle partitions as the data fill."""
    g = _cols(group_cols)
    ranged = hist.repartitionByRange(*([buckets] if buckets else []), *g, value_col)
    hb = cut_lineage(ranged.withColumn("_p", F.spark_partition_id()))
    by_group = Window.partitionBy(*g)
    offsets = hb.groupBy(*g, "_p").agg(F.sum("_w").alias("_pw")).select(
        *g, "_p", (F.sum("_pw").over(by_group.orderBy("_p")) - F.col("_pw")).alias("_off"), F.sum("_pw").over(by_group).alias("_n"))
    inside = F.sum("_w").over(Window.partitionBy(*g, "_p").orderBy(value_col)) - F.col("_w")
    return (_join_null_safe(hb.withColumn("_in", inside), offsets, g + ["_p"])
            .withColumn("_before", F.col("_off") + F.col("_in")).drop("_off", "_in", "_p"))


def exact_quantiles(df: DataFrame, group_cols, value_col: str, probs: dict[str, float],
                    weight_col: str | None = None, buckets: int | None = None,
                    hist: DataFrame | None = None) -> DataFrame:
    """Per group, quantiles by linear interpolation between closest ranks (as pandas / DuckDB
    ``quantile_cont``). ``probs`` maps output column → probability. Groups with no value are absent."""
    g = _cols(group_cols)
    h = hist if hist is not None else histogram(df, g, value_col, weight_col)
    pw = prefix_weights(h, g, value_col, buckets)
    aggs = []
    for name, q in probs.items():
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        lo = F.floor(pos)
        hi = F.ceil(pos)
        covers_lo = (F.col("_before") <= lo) & (lo < F.col("_before") + F.col("_w"))
        covers_hi = (F.col("_before") <= hi) & (hi < F.col("_before") + F.col("_w"))
        aggs += [F.max(F.when(covers_lo, F.col(value_col))).alias(f"_{name}_lo"),
                 F.max(F.when(covers_hi, F.col(value_col))).alias(f"_{name}_hi"),
                 F.max(pos - lo).alias(f"_{name}_frac")]
    out = pw.groupBy(*g).agg(*aggs)
    sel = list(g)
    for name in probs:
        lo_v, hi_v, frac = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_frac")
        sel.append((lo_v + (hi_v - lo_v) * frac).alias(name))
    return out.select(*sel)


def exact_median(df: DataFrame, group_cols, value_col: str, name: str = "median", **kw) -> DataFrame:
    return exact_quantiles(df, group_cols, value_col, {name: 0.5}, **kw)


def scalar_median(df: DataFrame, value_col: str) -> Column:
    """Median of a whole frame as a scalar-subquery column (null when every value is null)."""
    return exact_median(df, [], value_col, name="_m").select("_m").scalar()


def pct_rank(df: DataFrame, value_col: str, out_col: str, group_cols=None, key_cols=None,
             buckets: int | None = None) -> DataFrame:
    """Percentile rank with ties averaged: (rank of first tie + (ties - 1)/2) / non-null count; null values get a
    null rank.

    Distinct values are ranked (not rows). With ``key_cols``, which must determine the value within a group, the
    rank is carried to the keys first and ``df`` is joined on them instead of on the value; keys with two values raise."""
    g, keys = _cols(group_cols), _cols(key_cols)
    if not keys:
        pw = prefix_weights(histogram(df, g, value_col), g, value_col, buckets)
        found = pw.select(*g, F.col(value_col).alias("_rk_v"), _mid_rank().alias(out_col))
        cond = F.col(value_col) == F.col("_rk_v")
    else:
        cells = cut_lineage(df.filter(F.col(value_col).isNotNull()).groupBy(*g, *keys).agg(
            F.count(F.lit(1)).alias("_w"), F.min(value_col).alias("_lo"), F.max(value_col).alias("_hi")))
        one = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.raise_error(F.lit("a key with two values to rank")).cast("double"))
        cells = cells.select(*g, *keys, "_w", one.alias("_rk_v"))
        pw = prefix_weights(histogram(cells, g, "_rk_v", "_w"), g, "_rk_v", buckets)
        found = _join_null_safe(cells.drop("_w"), pw.select(*g, "_rk_v", _mid_rank().alias(out_col)), [*g, "_rk_v"])
        found = cut_lineage(found.select(*g, *keys, out_col))  # of known size: where it is small the rows stay where they are
        cond = F.col(value_col).isNotNull()
    right = found.select(*[F.col(c).alias(f"_rk_{c}") for c in [*g, *keys]], *(["_rk_v"] if not keys else []), out_col)
    on = [F.col(c).eqNullSafe(F.col(f"_rk_{c}")) for c in [*g, *keys]]
    return df.join(right, [*on, cond], "left").drop(*[f"_rk_{c}" for c in [*g, *keys]], "_rk_v")


def _mid_rank() -> Column:
    return (F.col("_before") + (F.col("_w") + 1) / F.lit(2.0)) / F.col("_n")
