"""Binding of the driver's ``events`` table to the reference's panel model.

One panel row = (cell, day, 15-minute slot) with a bounded demand value and the road / weather attributes.
The derivation is one aggregate over ``events`` keyed by (cell, day, slot): every aggregate is algebraic
(avg / min / max), so Spark combines map-side and only one row per group and task crosses the shuffle,
however hot a cell is. ``train`` and ``test`` are filters of the panel (pushed into the same scan).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.time import slot_minutes
from demandspark.sources.readers import read_table

# Binding of event attributes to panel categories (FIXTURES §2.1).
EVENT_TYPE_TO_ROAD = {"click": "Highway", "error": "Street", "purchase": "Residential", "signup": "Alley"}
K_MOD6_TO_WEATHER = {0: "Sunny", 1: "Foggy", 2: "Rainy", 3: "Snowy", 4: "Windy"}
USER_MOD3_TO_LARGE_VEHICLES = {0: "Allowed", 1: "Not Allowed"}
USER_MOD3_TO_LANDMARKS = {0: "Yes", 1: "No"}
#: Day 1 of the panel's day numbers, user ids of one cell, and the fewest characters of a cell (cells nest by prefix).
FIRST_DAY = "2024-01-01"
CELL_USERS = 10
CELL_CHARS = 6
SLOT_MINUTES = 15
DEMAND_SCALE = 500.0


@dataclass(frozen=True)
class PanelBinding:
    """Which panel rows form the labelled and unlabelled frames."""

    target_day: int                   # the day to predict (day 49 of the reference data)
    ref_day: int                      # the reference day (day 48)
    target_start: int = 135           # first target-day slot of the unlabelled frame (2:15)
    target_end: int = 825             # last target-day slot of the unlabelled frame (13:45)


def binding_of(events: DataFrame) -> PanelBinding:
    """The target day is the last day of ``events`` and the reference day the one before: one aggregate, of which
    one number comes back. Without events both are days that nothing is on."""
    last = events.agg(F.max(day_number(F.col("ts")))).first()[0]
    target = 0 if last is None else last
    return PanelBinding(target, target - 1)


def _case(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def cell_number(user_id: Column) -> Column:
    """Number of a user's cell: CELL_USERS ids in a row are one cell, so cells grow with the users."""
    return F.floor(user_id / CELL_USERS)


def cell_name(number: Column) -> Column:
    """A cell's number in base 32, at least CELL_CHARS characters: cells with a common prefix are users of one range."""
    digits = F.lower(F.conv(number.cast("string"), 10, 32))
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(CELL_CHARS)), "0")


def day_number(ts: Column) -> Column:
    """Days from FIRST_DAY on, which is day 1."""
    return (F.datediff(ts, F.lit(FIRST_DAY).cast("date")) + 1).cast("int")


#: The aggregates of a panel row, over the columns of ``event_columns``: batch and stream share them.
def panel_aggregates() -> list[Column]:
    return [F.avg("value").alias("_avg"), F.min("event_type").alias("_etype"), F.min("k").alias("_kmin"), F.max("k").alias("_kmax"),
            F.min("user_id").alias("_umin"), F.max("user_id").alias("_umax"), F.min("event_id").alias("Index")]


def event_columns() -> list[Column]:
    return [F.col("event_id"), F.col("event_type"), F.col("value"), F.col("user_id"), cell_number(F.col("user_id")).alias("u"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k")]


def panel_columns(day: Column, minute: Column) -> list[Column]:
    """A panel row from its aggregates, its cell number ``u``, its day and the minute its slot begins at."""
    return [
        cell_name(F.col("u")).alias("geohash"),
        day.cast("int").alias("day"),
        F.concat(F.floor(minute / 60).cast("int").cast("string"), F.lit(":"),
                 F.lpad((minute % 60).cast("string"), 2, "0")).alias("timestamp"),
        F.least(F.col("_avg") / DEMAND_SCALE, F.lit(1.0)).alias("demand"),
        _case(F.col("_etype"), EVENT_TYPE_TO_ROAD).alias("RoadType"),
        _case(F.col("_kmin") % 6, K_MOD6_TO_WEATHER).alias("Weather"),
        _case(F.col("_umin") % 3, USER_MOD3_TO_LARGE_VEHICLES).alias("LargeVehicles"),
        _case(F.col("_umax") % 3, USER_MOD3_TO_LANDMARKS).alias("Landmarks"),
        F.when(F.col("_kmax") % 6 != 0, F.col("_kmax") % 6).cast("double").alias("NumberofLanes"),
        F.when(F.col("_kmin") % 11 != 0, F.col("_kmin") * 2 - 60).cast("double").alias("Temperature"),
        F.col("Index"),
    ]


def panel_from_events(events: DataFrame) -> DataFrame:
    minute = (F.hour("ts") * 60 + F.floor(F.minute("ts") / SLOT_MINUTES) * SLOT_MINUTES).cast("int")
    e = events.select(*event_columns(), day_number(F.col("ts")).alias("dy"), minute.alias("m"))
    return e.groupBy("u", "dy", "m").agg(*panel_aggregates()).select(*panel_columns(F.col("dy"), F.col("m")))


def split_panel(panel: DataFrame, binding: PanelBinding) -> tuple[DataFrame, DataFrame]:
    """Labelled rows: all days up to the reference day, and the target day up to its first slot to predict."""
    tm = slot_minutes("timestamp")
    b = binding
    train = panel.filter((F.col("day") <= b.ref_day) | ((F.col("day") == b.target_day) & (tm < b.target_start)))
    test = panel.filter((F.col("day") == b.target_day) & tm.between(b.target_start, b.target_end)).drop("demand")
    return train, test


def load_panel(spark: SparkSession, data_dir: str) -> DataFrame:
    return panel_from_events(read_table(spark, data_dir, "events"))


def load_binding(spark: SparkSession, data_dir: str) -> PanelBinding:
    return binding_of(read_table(spark, data_dir, "events"))


def load_frames(spark: SparkSession, data_dir: str, binding: PanelBinding | None = None) -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled) frames bound to the data folder's ``events`` table."""
    return split_panel(load_panel(spark, data_dir), binding or load_binding(spark, data_dir))


def sample_submission(test: DataFrame) -> DataFrame:
    """The sample of the output: each unlabelled row's key and a constant."""
    return test.select("Index", F.lit(0.0).alias("demand"))
