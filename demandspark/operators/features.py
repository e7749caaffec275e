"""Base features of one frame (time, space, category, numeric, interactions) and frequency encodings.

``base_features`` is one projection over the frame plus scalar subqueries (the frame's exact medians of lanes and
temperature, found in one pass); nothing is joined and no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions import category as cat
from demandspark.functions import numeric as num
from demandspark.functions import space, time
from demandspark.operators.order_stats import exact_quantiles
from demandspark.session import cut_lineage

IMPUTED_BY_MEDIAN = ["NumberofLanes", "Temperature"]


def time_features(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """hour, minute, total_minutes, the five flags and the cyclic encodings."""
    df = df.withColumns({"hour": time.slot_hour(ts_col), "minute": time.slot_minute(ts_col)})
    df = df.withColumn("total_minutes", F.col("hour") * 60 + F.col("minute"))
    cols = dict(time.time_flags("hour"))
    cols.update(time.cyclic("hour", 24, "hour"))
    cols.update(time.cyclic("minute", 60, "minute"))
    cols.update(time.cyclic("total_minutes", 1440, "total"))
    return df.withColumns(cols)


def frame_medians(df: DataFrame, cols, frame_col: str | None = None) -> DataFrame:
    """(frame, column, median) of several columns in one exact, distributed pass: (column, value) pairs are counted
    and ranked over range partitions, so no task holds all values of a column. ``frame`` is null without
    ``frame_col``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    long = df.select((F.col(frame_col) if frame_col else F.lit(None).cast("int")).alias("frame"), pairs.alias("_p")).select("frame", "_p.*")
    return exact_quantiles(long, ["frame", "column"], "value", {"median": 0.5})


def impute_median(df: DataFrame, cols=IMPUTED_BY_MEDIAN, frame_col: str | None = None, frames=()) -> DataFrame:
    """Fill nulls with the frame's own exact median. Of frames stacked by ``frame_col`` (with the values ``frames``)
    each is filled from itself. The medians are scalar subqueries over a table of a few rows."""
    found = frame_medians(df, cols, frame_col)

    def fill(c: str):
        if not frame_col:
            return found.filter(F.col("column") == c).select("median").scalar()
        out = None
        for v in frames:
            m = found.filter((F.col("column") == c) & (F.col("frame") == v)).select("median").scalar()
            out = F.when(F.col(frame_col) == v, m) if out is None else out.when(F.col(frame_col) == v, m)
        return out

    return df.withColumns({c: F.coalesce(F.col(c), fill(c)) for c in cols})


def category_features(df: DataFrame) -> DataFrame:
    return category_codes(df.withColumns({c: cat.fill_unknown(c) for c in cat.CATEGORICAL_COLS}))


def category_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "road_type_ord": cat.road_type_ord("RoadType"),
        "weather_ord": cat.weather_ord("Weather"),
        "large_veh_bin": cat.indicator("LargeVehicles", cat.LARGE_VEHICLES_POSITIVE),
        "landmarks_bin": cat.indicator("Landmarks", cat.LANDMARKS_POSITIVE),
    })


def numeric_features(df: DataFrame, frame_col: str | None = None, frames=()) -> DataFrame:
    return temperature_features(impute_median(df, frame_col=frame_col, frames=frames))


def temperature_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"temp_extreme": num.temp_extreme("Temperature"),
                           "temp_band": num.temp_band("Temperature")})


def interaction_features(df: DataFrame) -> DataFrame:
    lanes, road, hour, peak = F.col("NumberofLanes"), F.col("road_type_ord"), F.col("hour"), F.col("peak_hour")
    return df.withColumns({
        "road_capacity": lanes * F.col("large_veh_bin"),
        "road_capacity2": lanes * road,
        # Weights of the congestion potential.
        "congestion_potential": road * 0.4 + lanes * 0.3 + F.col("landmarks_bin") * 0.2 + peak * 0.1,
        "road_x_hour": road * hour,
        "lanes_x_hour": lanes * hour,
        "lanes_x_peak": lanes * peak,
        "road_x_weather": road * F.col("weather_ord"),
    })


def base_features(df: DataFrame, frame_col: str | None = None, frames=()) -> DataFrame:
    """All base features of one frame, or of frames stacked by ``frame_col``."""
    df = time_features(df)
    df = df.withColumns(space.prefixes("geohash"))
    df = category_features(df)
    df = numeric_features(df, frame_col, frames)
    return interaction_features(df)


def derived_features(df: DataFrame) -> DataFrame:
    """The base features that follow from a row's own filled columns, in the order of ``base_features``: rows need not carry
    them through joins."""
    df = time_features(df)
    df = df.withColumns(space.prefixes("geohash"))
    return interaction_features(temperature_features(category_codes(df)))


# Keys counted by the frequency encoding.
FREQUENCY_KEYS = {"geohash": "geohash_freq", "gh_prefix4": "gh_prefix4_freq", "gh_prefix5": "gh_prefix5_freq"}


def frequency_tables(train: DataFrame, keys: dict[str, str] = FREQUENCY_KEYS) -> dict[str, DataFrame]:
    """Row count per key value of the labelled frame (null keys are not counted)."""
    return {key: train.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
            for key, out in keys.items()}


def apply_frequency(df: DataFrame, tables: dict[str, DataFrame], keys: dict[str, str] = FREQUENCY_KEYS) -> DataFrame:
    """Left-join each count table; unseen (and null) keys get 0. The tables are saved first, so that their size is known:
    Spark broadcasts small ones, and rows are dealt out for large ones only."""
    for key, out in keys.items():
        df = df.join(cut_lineage(tables[key]), key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))
    return df


def frequency_encode(train: DataFrame, test: DataFrame, keys: dict[str, str] = FREQUENCY_KEYS):
    """Counts from the labelled frame applied to both frames in one pass (stacked)."""
    from demandspark.operators.encoding import split_frames, stack_frames

    rows = apply_frequency(stack_frames(train, test), frequency_tables(train, keys), keys)
    return split_frames(rows, train.columns, test.columns)
