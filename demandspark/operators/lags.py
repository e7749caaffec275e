"""Reference-day lag features: per-cell statistics of the reference day, same-slot and shifted-slot lags,
leak guards and the imputed lag.

* Cell statistics (mean, std, max, min and three peak-hour means) come from **one** aggregate of the
  reference-day rows and **one** left join per frame.
* The exact lag and the eight shifted lags come from **one** wide table: the reference-day rows are
  replicated over the offsets (``explode``, no join), re-keyed to the slot that reads them
  (``slot - offset``) and pivoted by conditional aggregates, then joined once. A duplicate (cell, slot) on
  the reference day would fan rows out, so the pivot raises instead (``raise_error`` inside the plan).
* Leak guard: on labelled rows of the reference day every statistic and lag is nulled.
* ``demand_lag_1day_imputed`` = lag → cell mean → fallback, applied after the guard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.time import EVENING_PEAK, MORNING_PEAK
from demandspark.session import cut_lineage
from demandspark.sources.schemas import TARGET

# Shifts in minutes of the lag features and the reference's hard-coded fallback mean.
OFFSETS = [-60, -45, -30, -15, 15, 30, 45, 60]
REFERENCE_FALLBACK = 0.09394

LAG = "demand_lag_1day"
IMPUTED = "demand_lag_1day_imputed"


def offset_name(offset: int) -> str:
    return f"{LAG}_offset_{offset}" if offset > 0 else f"{LAG}_offset_m{abs(offset)}"


def lag_names(offsets=OFFSETS) -> list[str]:
    return [LAG] + [offset_name(o) for o in offsets]


def stat_names(prefix: str = "gh_day48") -> list[str]:
    return [f"{prefix}_{s}" for s in ("mean", "std", "max", "min", "peak_mean", "morning_peak_mean",
                                      "evening_peak_mean")]


def reference_rows(train: DataFrame, ref_day: int, day_col: str = "day") -> DataFrame:
    return train.filter(F.col(day_col) == ref_day)


def cell_stats(ref: DataFrame, entity: str = "geohash", target: str = TARGET, hour_col: str = "hour",
               prefix: str = "gh_day48") -> DataFrame:
    """One row per cell: mean / std / max / min and peak, morning-peak, evening-peak means of the target."""
    h = F.col(hour_col)
    morning = h.between(*MORNING_PEAK)
    evening = h.between(*EVENING_PEAK)
    y = F.col(target)
    n = stat_names(prefix)
    return (ref.filter(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.avg(y).alias(n[0]), F.stddev_samp(y).alias(n[1]), F.max(y).alias(n[2]), F.min(y).alias(n[3]),
        F.avg(F.when(morning | evening, y)).alias(n[4]),
        F.avg(F.when(morning, y)).alias(n[5]),
        F.avg(F.when(evening, y)).alias(n[6])))


def lag_table(ref: DataFrame, entity: str = "geohash", slot: str = "total_minutes", target: str = TARGET,
              offsets=OFFSETS) -> DataFrame:
    """(entity, slot) → exact lag and one column per offset. Slot t reads the reference slot t + offset
    (no wrap at midnight). Raises when a reference (entity, slot) is not unique."""
    all_offsets = [0] + list(offsets)
    shifted = (ref.select(entity, slot, target)
               .withColumn("_off", F.explode(F.array(*[F.lit(o) for o in all_offsets])))
               .withColumn(slot, F.col(slot) - F.col("_off"))
               .repartition(entity, slot))  # the pairs move, not a row of partial aggregates for each
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.max(F.when(F.col("_off") == o, F.col(target))).alias(n) for o, n in zip(all_offsets, lag_names(offsets))]
    aggs += [F.count_if(F.col("_off") == o).alias(f"_c{i}") for i, o in enumerate(all_offsets)]
    wide = shifted.groupBy(entity, slot).agg(*aggs)
    dup = F.greatest(*[F.col(f"_c{i}") for i in range(len(all_offsets))]) > 1
    guard = F.when(dup, F.raise_error(F.lit("duplicate (entity, slot) on the reference day"))).otherwise(F.lit(0))
    return wide.withColumn("_guard", guard).filter(F.col("_guard") == 0).drop(
        "_rows", "_guard", *[f"_c{i}" for i in range(len(all_offsets))])


def day_pairs(train: DataFrame, entity: str = "geohash", slot: str = "timestamp", day: str = "day", target: str = TARGET) -> DataFrame:
    """Each labelled row with that of its cell and slot one day before: day, entity, slot, demand_target, demand_ref. On
    two days these are the pairs of the target and the reference day."""
    here = train.select(day, entity, slot, F.col(target).alias("demand_target"))
    before = train.select((F.col(day) + 1).alias(day), entity, slot, F.col(target).alias("demand_ref"))
    return here.join(before, [day, entity, slot])


def impute_lag(df: DataFrame, fallback: Column, mean_col: str = "gh_day48_mean") -> DataFrame:
    return df.withColumn(IMPUTED, F.coalesce(F.col(LAG), F.col(mean_col), fallback))


def lag_rows(rows: DataFrame, ref_day: int, entity: str = "geohash", slot: str = "total_minutes",
             target: str = TARGET, offsets=OFFSETS, fallback: Column | float | None = REFERENCE_FALLBACK,
             mask_ref_day: bool = True, prefix: str = "gh_day48", labelled: Column | None = None) -> DataFrame:
    """Adds 7 statistics, 9 lags and the imputed lag to a frame (or to both frames stacked, where
    ``labelled`` marks the labelled rows: the reference day is read from them and only they are masked).

    ``fallback``: a constant (the reference hard-codes 0.09394), a Column, or None for the labelled rows'
    computed target mean.
    """
    is_lab = labelled if labelled is not None else F.lit(True)
    ref = rows.filter(is_lab & (F.col("day") == ref_day))
    stats = cut_lineage(cell_stats(ref, entity, target, prefix=prefix))  # of known size
    lags = lag_table(ref, entity, slot, target, offsets)
    if fallback is None:
        fb = rows.filter(is_lab).select(F.avg(target)).scalar()
    elif isinstance(fallback, Column):
        fb = fallback
    else:
        fb = F.lit(float(fallback))
    s_names, l_names = stat_names(prefix), lag_names(offsets)
    out = rows.join(lags, [entity, slot], "left").join(stats, entity, "left")
    if mask_ref_day:
        keep = ~(is_lab & (F.col("day") == ref_day))
        out = out.withColumns({c: F.when(keep, F.col(c)) for c in s_names + l_names})
    return impute_lag(out, fb, s_names[0])


def add_reference_day_lags(train: DataFrame, test: DataFrame, ref_day: int, entity: str = "geohash",
                           slot: str = "total_minutes", target: str = TARGET, offsets=OFFSETS,
                           fallback: Column | float | None = REFERENCE_FALLBACK, mask_ref_day: bool = True,
                           prefix: str = "gh_day48") -> tuple[DataFrame, DataFrame]:
    """Both frames in one pass (stacked): one statistics join and one wide lag join for all rows."""
    from demandspark.operators.encoding import FRAME, LABELLED, split_frames, stack_frames

    rows = stack_frames(train, test)
    rows = lag_rows(rows, ref_day, entity, slot, target, offsets, fallback, mask_ref_day, prefix,
                    labelled=F.col(FRAME) == LABELLED)
    return split_frames(rows, train.columns, test.columns)
