"""Streaming panel and stream-static enrichment against the batch plan; declared-schema CSV round trip."""

import uuid

from pyspark.sql import functions as F

from demandspark.operators.encoding import FRAME, LABELLED, stack_frames
from demandspark.operators.lags import lag_names, lag_rows, stat_names
from demandspark.plans.flagship import base_frames
from demandspark.sources.panel import load_frames, load_panel
from demandspark.sources.readers import read_train_csv
from demandspark.streaming.panel_stream import (enrich_stream, events_source_path, panel_stream, read_events_stream,
                                                run_to_table, scoring_tables)
from tests.conftest import SF_SMALL


def test_stream_panel_equals_batch_panel(spark):
    stream = panel_stream(read_events_stream(spark, events_source_path(SF_SMALL)), watermark=None)
    got = run_to_table(stream, "p_" + uuid.uuid4().hex[:10])
    want = load_panel(spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_enrich_stream_matches_batch_lags(spark):
    fr = base_frames(spark, SF_SMALL, checkpoint=False)
    ref = fr.binding.ref_day
    tables = scoring_tables(fr.train, ref)
    # arriving rows: the unlabelled frame streamed from the events source, restricted to its slots
    stream = panel_stream(read_events_stream(spark, events_source_path(SF_SMALL)), watermark=None)
    arrived = run_to_table(stream, "a_" + uuid.uuid4().hex[:10])
    keys = fr.test.select("Index")
    rows = arrived.join(keys, "Index", "left_semi").drop("demand")
    cols = ["Index"] + stat_names() + lag_names() + ["demand_lag_1day_imputed", "geohash_freq"]
    got = enrich_stream(rows, tables).select(*cols)
    batch = lag_rows(stack_frames(fr.train, fr.test), ref, labelled=F.col(FRAME) == LABELLED)
    want_rows = batch.filter(F.col(FRAME) != LABELLED)
    freq = fr.train.groupBy("geohash").agg(F.count(F.lit(1)).alias("geohash_freq"))
    want = (want_rows.join(freq, "geohash", "left")
            .withColumn("geohash_freq", F.coalesce("geohash_freq", F.lit(0)).cast("long")).select(*cols))
    assert got.count() == fr.test.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_csv_round_trip_with_declared_schema(spark, tmp_path):
    train, _ = load_frames(spark, SF_SMALL)
    cols = ["Index", "geohash", "day", "timestamp", "RoadType", "NumberofLanes", "LargeVehicles", "Landmarks",
            "Temperature", "Weather", "demand"]
    path = str(tmp_path / "train_csv")
    train.select(*cols).write.option("header", True).csv(path)
    back = read_train_csv(spark, path)
    assert back.columns == cols
    assert back.exceptAll(train.select(*cols)).count() == 0 and train.select(*cols).exceptAll(back).count() == 0


def test_csv_without_row_key_and_with_nan(spark, tmp_path):
    from demandspark.sources.readers import nan_to_null, read_test_csv
    from demandspark.sources.schemas import ROW_KEY, TEST_SCHEMA
    names = [f.name for f in TEST_SCHEMA.fields if f.name != ROW_KEY]
    row = ["1" if f.dataType.typeName() != "string" else "7:15" for f in TEST_SCHEMA.fields if f.name != ROW_KEY]
    (tmp_path / "t.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    got = read_test_csv(spark, str(tmp_path / "t.csv"))
    assert got.columns == TEST_SCHEMA.fieldNames() and got.first()[ROW_KEY] is not None
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in nan_to_null(df).collect()] == [None, 1.0]


def test_panel_grows_with_events(spark):
    from pyspark.sql import functions as F

    from demandspark.sources.panel import panel_from_events
    events = spark.range(60_000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 4000) * 900).alias("ts"),
        F.lit("click").alias("event_type"), F.lit(10.0).alias("value"), (F.col("id") % 50_021).alias("user_id"),
        F.lit('{"k": 3}').alias("props"))
    panel = panel_from_events(events)
    assert panel.count() == 60_000 and panel.select("geohash").distinct().count() == 5_003
    assert panel.agg(F.max("day")).first()[0] == 42
