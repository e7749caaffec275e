"""Structured Streaming form of the panel and of scoring-time enrichment.

* ``panel_stream``: the events → panel binding as a streaming aggregation over 15-minute event-time windows
  per cell. With a watermark the state of a slot is dropped when it passes the slot's end; ``run_to_table`` keeps the
  rows in files.
* ``enrich_stream``: stream-static left joins of arriving panel rows with lookup tables computed in batch
  from the labelled frame (cell statistics and the wide lag table of the reference day, frequencies) — the
  scoring path of the unlabelled frame, applied to rows as they arrive.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions import numeric as num
from demandspark.functions import space
from demandspark.operators import features as fe
from demandspark.operators.features import frequency_tables
from demandspark.operators.lags import IMPUTED, REFERENCE_FALLBACK, cell_stats, lag_table, reference_rows, stat_names
from demandspark.session import ensure_checkpoint_dir
from demandspark.sources.panel import SLOT_MINUTES, day_number, event_columns, panel_aggregates, panel_columns

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def events_source_path(data_dir: str, name: str = "events") -> str:
    """File-source path of a table: a folder of parts as is, a single file as a one-file glob (the file
    source lists a folder or a glob, not a plain file)."""
    path = os.path.join(data_dir, f"{name}.parquet")
    return path if os.path.isdir(path) else path[:-1] + "[" + path[-1] + "]"


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def panel_stream(events: DataFrame, watermark: str | None = "30 minutes") -> DataFrame:
    """Streaming panel rows: same columns and values as ``sources.panel.panel_from_events``."""
    if watermark:
        events = events.withWatermark("ts", watermark)
    g = events.select("ts", *event_columns()).groupBy(F.window("ts", f"{SLOT_MINUTES} minutes").alias("w"), "u").agg(*panel_aggregates())
    start = F.col("w.start")
    return g.select(*panel_columns(day_number(start), F.hour(start) * 60 + F.minute(start)))


def run_to_table(df: DataFrame, name: str, keys=("geohash", "day", "timestamp")) -> DataFrame:
    """Drive a streaming aggregation over all available input and return its result.

    Each micro-batch's changed rows go to Parquet files in the session's shared folder, written by the tasks with the
    batch's number; the result is the last version of each key. Nothing passes through the driver but file names. A
    batch that is run again replaces its own files. With a watermark the state of closed windows is let go."""
    spark = df.sparkSession
    folder = os.path.join(ensure_checkpoint_dir(spark), "streams", name)

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    q = (df.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], df.schema)  # no input at all
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{folder}/rows")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), "batch").alias("_r"))
    return last.select(*[F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def scoring_tables(train_features: DataFrame, ref_day: int) -> dict[str, DataFrame]:
    """Batch lookups for scoring: reference-day cell statistics, wide lag table, frequency tables."""
    ref = reference_rows(train_features, ref_day)
    return {"stats": cell_stats(ref), "lags": lag_table(ref), **{f"freq_{k}": v for k, v in frequency_tables(train_features).items()}}


def enrich_stream(rows: DataFrame, tables: dict[str, DataFrame], fallback: float = REFERENCE_FALLBACK) -> DataFrame:
    """Stream-static left joins of arriving (unlabelled) panel rows with the batch lookup tables.

    Median imputation needs the whole frame, which a stream never has: arriving rows keep nulls there."""
    feats = base_features_streaming(rows)
    out = feats.join(tables["stats"], "geohash", "left").join(tables["lags"], ["geohash", "total_minutes"], "left")
    for name, t in tables.items():
        if name.startswith("freq_"):
            key = name[len("freq_"):]
            col = [c for c in t.columns if c != key][0]
            out = out.join(t, key, "left").withColumn(col, F.coalesce(F.col(col), F.lit(0)).cast("long"))
    return out.withColumn(IMPUTED, F.coalesce(F.col("demand_lag_1day"), F.col(stat_names()[0]), F.lit(fallback)))


def base_features_streaming(rows: DataFrame) -> DataFrame:
    """Base features without the whole-frame median (not defined on an unbounded stream)."""
    df = fe.time_features(rows)
    df = df.withColumns(space.prefixes("geohash"))
    df = fe.category_features(df)
    df = df.withColumns({"temp_extreme": num.temp_extreme("Temperature"), "temp_band": num.temp_band("Temperature")})
    return fe.interaction_features(df)


__all__ = ["EVENTS_SCHEMA", "events_source_path", "read_events_stream", "panel_stream", "run_to_table",
           "scoring_tables", "enrich_stream", "base_features_streaming"]
