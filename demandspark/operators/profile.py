"""Data profiling: shapes, missing values, duplicates, target distribution, cardinalities, key and slot
overlaps. Every profile is a lazy DataFrame; wide per-column statistics are one aggregate pass followed by an
unpivot, and overlaps are ``intersect`` of distinct keys (shuffled, never collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.metrics import kurtosis_unbiased, skew_unbiased
from demandspark.functions.time import slot_label, slot_minutes
from demandspark.operators.order_stats import exact_quantiles
from demandspark.sources.schemas import TARGET


def _count(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def shape(frames: dict[str, DataFrame]) -> DataFrame:
    """(frame, rows, columns) per named frame."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("frame"), "rows", F.lit(len(df.columns)).alias("columns"))
        out = part if out is None else out.unionByName(part)
    return out


def missing_counts(df: DataFrame, frame: str | None = None) -> DataFrame:
    """(frame, position, column, missing, rows): one aggregate pass over all columns, then an unpivot."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                                         F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)]))
    long = wide.select(F.col("_rows").alias("rows"), stack.alias("_s")).select("_s.*", "rows")
    return long.select(F.lit(frame).alias("frame"), "position", "column", "missing", "rows")


def missing_pct(left: DataFrame, right: DataFrame, left_name: str = "train", right_name: str = "test",
                digits: int = 2) -> DataFrame:
    """Missing % per column of two frames side by side (full outer join on the column name), rounded, kept
    when either side is > 0."""
    def pct(df, name):
        m = missing_counts(df)
        return m.select("column", F.round(F.col("missing") * 100.0 / F.col("rows"), digits).alias(f"{name}_pct"))
    a, b = pct(left, left_name), pct(right, right_name)
    j = a.join(b, "column", "full_outer")
    return j.filter(F.greatest(f"{left_name}_pct", f"{right_name}_pct") > 0)


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Rows minus distinct rows (nulls compare equal), via one group-by over the columns."""
    cols = list(cols or df.columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates")))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 % (linear interpolation, exact), max."""
    base = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_quantiles(df, [], col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    qs = q.select(F.struct("q25", "q50", "q75")).scalar()
    return base.withColumn("_q", qs).select("count", "mean", "std", "min", "_q.q25", "_q.q50", "_q.q75", "max")


def skew_kurtosis(df: DataFrame, col: str = TARGET) -> DataFrame:
    return df.agg(skew_unbiased(col).alias("skewness"), kurtosis_unbiased(col).alias("kurtosis"))


def nunique(df: DataFrame) -> DataFrame:
    """(position, column, nunique): distinct non-null values per column."""
    cols = df.columns
    wide = df.agg(*[F.countDistinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                                         F.col(f"_d{i}").alias("nunique")) for i, c in enumerate(cols)]))
    return wide.select(stack.alias("_s")).select("_s.*")


def key_overlap(a: DataFrame, b: DataFrame, cols) -> DataFrame:
    """(overlap, left_keys, right_keys): distinct keys of each side and of their intersection."""
    cols = list(cols)
    da, db = a.select(*cols).distinct(), b.select(*cols).distinct()
    return da.intersect(db).agg(F.count(F.lit(1)).alias("overlap")).select(
        "overlap", _count(da).alias("left_keys"), _count(db).alias("right_keys"))


def cell_overlap(train: DataFrame, test: DataFrame, cell: str = "geohash") -> DataFrame:
    ov = key_overlap(train.filter(F.col(cell).isNotNull()), test.filter(F.col(cell).isNotNull()), [cell])
    return ov.select("overlap", F.col("right_keys").alias("test_cells"),
                     (F.col("overlap") * 100.0 / F.col("right_keys")).alias("pct_of_test"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def day_range(df: DataFrame, col: str = "day") -> DataFrame:
    return df.agg(F.min(col).alias("min_day"), F.max(col).alias("max_day"), F.countDistinct(col).alias("n_days"))


def head(df: DataFrame, cols, n: int, order: str = "Index") -> DataFrame:
    """First ``n`` rows in file order (the row key makes the order explicit)."""
    return df.orderBy(order).limit(n).select(order, *cols)


def rows_by_day(df: DataFrame, days, col: str = "day") -> DataFrame:
    return df.filter(F.col(col).isin(list(days))).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def slots_by_day(df: DataFrame, days, ts: str = "timestamp", col: str = "day") -> DataFrame:
    return df.filter(F.col(col).isin(list(days))).groupBy(col).agg(F.countDistinct(ts).alias("slots"))


def slot_overlap(a: DataFrame, b: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Distinct slots in both, over the distinct slots of ``b`` (the reference's x / y)."""
    ov = key_overlap(a.filter(F.col(ts).isNotNull()), b.filter(F.col(ts).isNotNull()), [ts])
    return ov.select("overlap", F.col("right_keys").alias("of"))


def distinct_count(df: DataFrame, cols, out: str) -> DataFrame:
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(out))


def target_slots(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Sorted distinct minutes of the day with their ``H:MM`` label."""
    m = df.select(slot_minutes(ts).alias("minutes")).distinct()
    return m.select("minutes", slot_label("minutes").alias("label")).orderBy("minutes")


def slots_per_cell(df: DataFrame, cell: str = "geohash", ts: str = "timestamp") -> DataFrame:
    """Distinct slots per cell, then ``describe`` of that distribution (two-level aggregate)."""
    per_cell = df.filter(F.col(cell).isNotNull()).groupBy(cell).agg(F.countDistinct(ts).alias("slots"))
    return describe(per_cell, "slots")
