"""Query catalog: every operator of the inventory as a named query over a data folder, with its DuckDB oracle.

Each entry is ``Query(fn, sql, doubles)``: ``fn(spark, data_dir) -> DataFrame``; ``sql`` the oracle (None when
the operator is not SQL-expressible, e.g. model fitting); ``doubles`` the double columns the oracle rounds.
On the Spark side every double column is rounded the same way by ``finish``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.metrics import r2
from demandspark.operators import cv
from demandspark.operators import domain as dom
from demandspark.operators import ensemble as ens
from demandspark.operators import errors as err
from demandspark.operators import profile as prof
from demandspark.operators.encoding import ENCODING_SPECS, FOLD, FRAME, LABELLED, encode_rows, split_frames, stack_frames
from demandspark.operators.features import frequency_encode
from demandspark.operators.lags import IMPUTED, cell_stats, day_pairs, lag_names, lag_rows, lag_table, stat_names
from demandspark.operators.matrix import categorical_features, feature_matrix, numeric_features
from demandspark.plans import oracle as O
from demandspark.plans.flagship import Frames, base_frames, build_features
from demandspark.session import cut_lineage
from demandspark.sources.panel import load_binding, load_frames, sample_submission
from demandspark.sources.schemas import ROW_KEY, TARGET

REF, TGT = O.REF, O.TGT  # in SQL


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)


def finish(df: DataFrame) -> DataFrame:
    """Round doubles to 9 digits with the same IEEE arithmetic as the oracle.

    First to 12 digits (absorbs last-ulp differences from summation order: the values here are exact decimals
    of at most 10 digits, never near a 12-digit tie), then half-up to 9 digits. Engine ``round`` functions
    disagree on exact decimal ties; these plain floor/multiply steps are bit-identical in both engines.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name).cast("double")
            twelve = F.floor(c * F.lit(1e12) + F.lit(0.5))
            nine = F.floor(twelve / F.lit(1000.0) + F.lit(0.5)) / F.lit(1e9)
            # a long holds 12 digits of values up to some 9e6; larger ones and NaN stay as they are
            cols.append(F.when(F.isnan(c) | (F.abs(c) >= 9e6), c).otherwise(nine).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_finish(body: str, doubles, extra_ctes: str = "", base: bool = True) -> str:
    """Wrap ``body`` (a SELECT over the base CTEs) rounding ``doubles`` like ``finish``."""
    inner = O.with_base(body, extra_ctes) if base else body
    if doubles:
        rep = ", ".join(f"floor(floor(CAST({c} AS DOUBLE) * 1e12 + 0.5::DOUBLE) / 1000.0::DOUBLE + 0.5::DOUBLE) / 1e9 AS {c}"
                        for c in doubles)
        return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) q"
    return inner


# ---- frame builders ---------------------------------------------------------------------------------------

def raw(spark, d):
    """Labelled frame, unlabelled frame, and the days they are bound to."""
    days = load_binding(spark, d)
    return *load_frames(spark, d, days), days


def base(spark, d) -> Frames:
    """Base features of both frames over a materialised panel (``events`` is aggregated once)."""
    return base_frames(spark, d, checkpoint=False, cut_panel=True)


def _rows_op(fr: Frames, op, pre_cut: bool = False) -> Frames:
    """Run ``op`` once on both frames stacked, materialise once, split back. ``pre_cut`` materialises the
    stacked input first (for ops that read it several times, like the encodings)."""
    rows = stack_frames(fr.train, fr.test)
    rows = cut_lineage(op(cut_lineage(rows) if pre_cut else rows))
    tr, te = split_frames(rows, fr.train.columns, fr.test.columns)
    return Frames(tr, te, fr.te_cols, fr.binding)


def lagged(spark, d, fallback=0.09394) -> Frames:
    fr = base(spark, d)
    return _rows_op(fr, lambda rows: lag_rows(rows, fr.binding.ref_day, fallback=fallback, labelled=F.col(FRAME) == LABELLED))


def encoded(spark, d, specs, lags=True, narrow=False) -> Frames:
    """``narrow``: rows with the row key, what the encodings read and the encodings, and no other features."""
    fr = lagged(spark, d) if lags else base(spark, d)
    if narrow:
        used = {ROW_KEY, FOLD, TARGET, *(k for s in specs for k in s.keys)}
        fr = Frames(*[f.select(*[c for c in f.columns if c in used]) for f in (fr.train, fr.test)], fr.te_cols, fr.binding)
    out = _rows_op(fr, lambda rows: encode_rows(rows, specs), pre_cut=not lags)
    return Frames(out.train, out.test, [s.name for s in specs], out.binding)


def both(fr: Frames, cols) -> DataFrame:
    """Union of the two frames' ``cols`` with a ``frame`` label."""
    a = fr.train.select(F.lit("train").alias("frame"), *cols)
    b = fr.test.select(F.lit("test").alias("frame"), *cols)
    return a.unionByName(b)


def sql_both(cols: str, left: str = "ftrain", right: str = "ftest") -> str:
    return f"SELECT 'train' AS frame, {cols} FROM {left} UNION ALL SELECT 'test' AS frame, {cols} FROM {right}"


Q: dict[str, Query] = {}


def reg(name, sql=None, doubles=()):
    def deco(fn):
        Q[name] = Query(lambda spark, d: finish(fn(spark, d)), sql, list(doubles))
        return fn
    return deco


RAW_TRAIN = O.RAW
RAW_TEST = [c for c in O.RAW if c != TARGET]

# ---- sources -------------------------------------------------------------------------------------------------


@reg("scan_train", sql_finish(f"SELECT {', '.join(RAW_TRAIN)} FROM train",
                              ["demand", "NumberofLanes", "Temperature"]), ["demand", "NumberofLanes", "Temperature"])
def _scan_train(spark, d):
    return raw(spark, d)[0]


@reg("scan_test", sql_finish(f"SELECT {', '.join(RAW_TEST)} FROM test", ["NumberofLanes", "Temperature"]))
def _scan_test(spark, d):
    return raw(spark, d)[1]


# ---- profiling -----------------------------------------------------------------------------------------------

@reg("aud_shape", sql_finish("SELECT 'train' AS frame, count(*) AS rows, 11 AS columns FROM train "
                             "UNION ALL SELECT 'test' AS frame, count(*) AS rows, 10 AS columns FROM test "
                             "UNION ALL SELECT 'sample' AS frame, count(*) AS rows, 2 AS columns FROM (SELECT Index, 0 AS demand FROM test)", []))
def _aud_shape(spark, d):
    tr, te, days = raw(spark, d)
    return prof.shape({"train": tr, "test": te, "sample": sample_submission(te)})


def _missing_sql(frame: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{frame}' AS frame, {i + 1} AS position, '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"count(*) AS rows FROM {frame}" for i, c in enumerate(cols))


@reg("aud_missing_count", sql_finish(_missing_sql("train", RAW_TRAIN) + " UNION ALL " + _missing_sql("test", RAW_TEST), []))
def _aud_missing_count(spark, d):
    tr, te, days = raw(spark, d)
    return prof.missing_counts(tr, "train").unionByName(prof.missing_counts(te, "test"))


@reg("aud_missing_pct", sql_finish(
    f"""SELECT coalesce(a."column", b."column") AS "column", a.train_pct, b.test_pct
FROM (SELECT "column", round(missing * 100.0::DOUBLE / rows, 2) AS train_pct FROM ({_missing_sql('train', RAW_TRAIN)})) a
FULL OUTER JOIN (SELECT "column", round(missing * 100.0::DOUBLE / rows, 2) AS test_pct FROM ({_missing_sql('test', RAW_TEST)})) b
ON a."column" = b."column"
WHERE greatest(a.train_pct, b.test_pct) > 0""", ["train_pct", "test_pct"]))
def _aud_missing_pct(spark, d):
    tr, te, days = raw(spark, d)
    return prof.missing_pct(tr, te)


@reg("aud_duplicates", sql_finish(
    """SELECT 'train' AS frame,
  (SELECT count(*) FROM train) - (SELECT count(*) FROM (SELECT DISTINCT geohash, day, RoadType, Weather FROM train)) AS projected_duplicates,
  (SELECT count(*) FROM train) - (SELECT count(*) FROM (SELECT DISTINCT * FROM train)) AS row_duplicates
UNION ALL SELECT 'test' AS frame,
  (SELECT count(*) FROM test) - (SELECT count(*) FROM (SELECT DISTINCT geohash, day, RoadType, Weather FROM test)),
  (SELECT count(*) FROM test) - (SELECT count(*) FROM (SELECT DISTINCT * FROM test))""", []))
def _aud_duplicates(spark, d):
    tr, te, days = raw(spark, d)
    proj = ["geohash", "day", "RoadType", "Weather"]
    out = None
    for name, df in (("train", tr), ("test", te)):
        p = prof.duplicate_rows(df, proj).select(F.col("duplicates").alias("projected_duplicates"))
        full = prof.duplicate_rows(df).select("duplicates").scalar()
        row = p.select(F.lit(name).alias("frame"), "projected_duplicates", full.alias("row_duplicates"))
        out = row if out is None else out.unionByName(row)
    return out


DESCRIBE_D = ["mean", "std", "min", "q25", "q50", "q75", "max"]


def _describe_sql(col: str, src: str) -> str:
    return (f"SELECT count({col}) AS count, avg({col}) AS mean, stddev_samp({col}) AS std, min({col}) AS min, "
            f"quantile_cont({col}, 0.25) AS q25, quantile_cont({col}, 0.5) AS q50, quantile_cont({col}, 0.75) AS q75, "
            f"max({col}) AS max FROM {src}")


@reg("aud_describe_target", sql_finish(_describe_sql("demand", "train"), DESCRIBE_D))
def _aud_describe_target(spark, d):
    return prof.describe(raw(spark, d)[0], TARGET)


@reg("aud_skew_kurtosis", sql_finish("SELECT skewness(demand) AS skewness, kurtosis(demand) AS kurtosis FROM train",
                                     ["skewness", "kurtosis"]))
def _aud_skew_kurtosis(spark, d):
    return prof.skew_kurtosis(raw(spark, d)[0])


@reg("aud_nunique", sql_finish(" UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS \"column\", count(DISTINCT {c}) AS nunique FROM train"
    for i, c in enumerate(RAW_TRAIN)), []))
def _aud_nunique(spark, d):
    return prof.nunique(raw(spark, d)[0])


@reg("aud_cell_overlap", sql_finish(
    """SELECT (SELECT count(*) FROM (SELECT geohash FROM train WHERE geohash IS NOT NULL INTERSECT
                                     SELECT geohash FROM test WHERE geohash IS NOT NULL)) AS overlap,
       (SELECT count(DISTINCT geohash) FROM test) AS test_cells,
       (SELECT count(*) FROM (SELECT geohash FROM train INTERSECT SELECT geohash FROM test WHERE geohash IS NOT NULL))
         * 100.0::DOUBLE / (SELECT count(DISTINCT geohash) FROM test) AS pct_of_test""", ["pct_of_test"]))
def _aud_cell_overlap(spark, d):
    tr, te, days = raw(spark, d)
    return prof.cell_overlap(tr, te)


@reg("aud_days", sql_finish("SELECT DISTINCT 'train' AS frame, day FROM train WHERE day IS NOT NULL "
                            "UNION ALL SELECT DISTINCT 'test' AS frame, day FROM test WHERE day IS NOT NULL", []))
def _aud_days(spark, d):
    tr, te, days = raw(spark, d)
    return (prof.distinct_sorted(tr, "day").select(F.lit("train").alias("frame"), "day")
            .unionByName(prof.distinct_sorted(te, "day").select(F.lit("test").alias("frame"), "day")).orderBy("frame", "day"))


@reg("aud_day_range", sql_finish(
    "SELECT 'train' AS frame, min(day) AS min_day, max(day) AS max_day, count(DISTINCT day) AS n_days FROM train "
    "UNION ALL SELECT 'test', min(day), max(day), count(DISTINCT day) FROM test", []))
def _aud_day_range(spark, d):
    tr, te, days = raw(spark, d)
    return (prof.day_range(tr).select(F.lit("train").alias("frame"), "*")
            .unionByName(prof.day_range(te).select(F.lit("test").alias("frame"), "*")))


@reg("aud_head", sql_finish("SELECT Index, geohash, timestamp FROM train ORDER BY Index LIMIT 10", []))
def _aud_head(spark, d):
    return prof.head(raw(spark, d)[0], ["geohash", "timestamp"], 10)


@reg("aud_rows_by_day", sql_finish(
    f"SELECT 'train' AS frame, day, count(*) AS rows FROM train WHERE day IN ({REF}, {TGT}) GROUP BY day "
    f"UNION ALL SELECT 'test', day, count(*) FROM test WHERE day IN ({REF}, {TGT}) GROUP BY day", []))
def _aud_rows_by_day(spark, d):
    tr, te, days = raw(spark, d)
    return (prof.rows_by_day(tr, [days.ref_day, days.target_day]).select(F.lit("train").alias("frame"), "day", "rows")
            .unionByName(prof.rows_by_day(te, [days.ref_day, days.target_day]).select(F.lit("test").alias("frame"), "day", "rows")))


@reg("aud_slots_by_day", sql_finish(
    f"SELECT 'train' AS frame, day, count(DISTINCT timestamp) AS slots FROM train WHERE day IN ({REF}, {TGT}) GROUP BY day "
    f"UNION ALL SELECT 'test', day, count(DISTINCT timestamp) FROM test WHERE day IN ({REF}, {TGT}) GROUP BY day", []))
def _aud_slots_by_day(spark, d):
    tr, te, days = raw(spark, d)
    return (prof.slots_by_day(tr, [days.ref_day, days.target_day]).select(F.lit("train").alias("frame"), "day", "slots")
            .unionByName(prof.slots_by_day(te, [days.ref_day, days.target_day]).select(F.lit("test").alias("frame"), "day", "slots")))


def _slot_ov_sql(name, a, b):
    return (f"SELECT '{name}' AS pair, (SELECT count(*) FROM (SELECT timestamp FROM {a} WHERE timestamp IS NOT NULL "
            f"INTERSECT SELECT timestamp FROM {b} WHERE timestamp IS NOT NULL)) AS overlap, "
            f"(SELECT count(DISTINCT timestamp) FROM {b}) AS \"of\"")


@reg("aud_slot_overlap", sql_finish(
    " UNION ALL ".join([_slot_ov_sql("train_ref~train_target", f"(SELECT * FROM train WHERE day = {REF})", f"(SELECT * FROM train WHERE day = {TGT})"),
                        _slot_ov_sql("test_target~train_target", f"(SELECT * FROM train WHERE day = {TGT})", f"(SELECT * FROM test WHERE day = {TGT})"),
                        _slot_ov_sql("test_target~train_ref", f"(SELECT * FROM train WHERE day = {REF})", f"(SELECT * FROM test WHERE day = {TGT})")]), []))
def _aud_slot_overlap(spark, d):
    tr, te, days = raw(spark, d)
    tr_ref, tr_tgt, te_tgt = (df.filter(F.col("day") == day) for df, day in ((tr, days.ref_day), (tr, days.target_day), (te, days.target_day)))
    parts = [("train_ref~train_target", tr_ref, tr_tgt), ("test_target~train_target", tr_tgt, te_tgt),
             ("test_target~train_ref", tr_ref, te_tgt)]
    out = None
    for name, a, b in parts:
        row = prof.slot_overlap(a, b).select(F.lit(name).alias("pair"), "overlap", "of")
        out = row if out is None else out.unionByName(row)
    return out


@reg("aud_cells", sql_finish("SELECT 'train' AS frame, count(DISTINCT geohash) AS cells FROM train "
                             "UNION ALL SELECT 'test', count(DISTINCT geohash) FROM test", []))
def _aud_cells(spark, d):
    tr, te, days = raw(spark, d)
    return (tr.agg(F.countDistinct("geohash").alias("cells")).select(F.lit("train").alias("frame"), "cells")
            .unionByName(te.agg(F.countDistinct("geohash").alias("cells")).select(F.lit("test").alias("frame"), "cells")))


@reg("aud_cell_slot_groups", sql_finish(
    f"SELECT 'train' AS frame, count(*) AS groups FROM (SELECT DISTINCT geohash, timestamp FROM train WHERE day = {TGT}) "
    f"UNION ALL SELECT 'test', count(*) FROM (SELECT DISTINCT geohash, timestamp FROM test WHERE day = {TGT})", []))
def _aud_cell_slot_groups(spark, d):
    tr, te, days = raw(spark, d)
    return (prof.distinct_count(tr.filter(F.col("day") == days.target_day), ["geohash", "timestamp"], "groups")
            .select(F.lit("train").alias("frame"), "groups")
            .unionByName(prof.distinct_count(te.filter(F.col("day") == days.target_day), ["geohash", "timestamp"], "groups")
                         .select(F.lit("test").alias("frame"), "groups")))


@reg("aud_pair_overlap", sql_finish(
    f"SELECT count(*) AS overlap FROM (SELECT geohash, timestamp FROM train WHERE day = {TGT} "
    f"INTERSECT SELECT geohash, timestamp FROM test WHERE day = {TGT})", []))
def _aud_pair_overlap(spark, d):
    tr, te, days = raw(spark, d)
    a = tr.filter(F.col("day") == days.target_day).select("geohash", "timestamp")
    b = te.filter(F.col("day") == days.target_day).select("geohash", "timestamp")
    return a.intersect(b).agg(F.count(F.lit(1)).alias("overlap"))


def _slots_sql(label: bool) -> str:
    lab = ", printf('%d:%02d', CAST(floor(minutes / 60) AS INTEGER), CAST(minutes % 60 AS INTEGER)) AS label" if label else ""
    return (f"SELECT frame, minutes{lab} FROM (SELECT DISTINCT 'train' AS frame, {O.H} * 60 + {O.M} AS minutes FROM train WHERE day = {TGT} "
            f"UNION ALL SELECT DISTINCT 'test' AS frame, {O.H} * 60 + {O.M} AS minutes FROM test WHERE day = {TGT})")


def _target_slots(spark, d, label):
    tr, te, days = raw(spark, d)
    out = None
    for name, df in (("train", tr), ("test", te)):
        s = prof.target_slots(df.filter(F.col("day") == days.target_day))
        s = s.select(F.lit(name).alias("frame"), "minutes", *(["label"] if label else []))
        out = s if out is None else out.unionByName(s)
    return out.orderBy("frame", "minutes")


Q["aud_target_slots"] = Query(lambda s, d: finish(_target_slots(s, d, False)), sql_finish(_slots_sql(False), []))
Q["aud_slot_labels"] = Query(lambda s, d: finish(_target_slots(s, d, True)), sql_finish(_slots_sql(True), []))


@reg("aud_target_cells", sql_finish(
    f"""SELECT (SELECT count(DISTINCT geohash) FROM train WHERE day = {TGT}) AS train_cells,
       (SELECT count(DISTINCT geohash) FROM test WHERE day = {TGT}) AS test_cells,
       (SELECT count(*) FROM (SELECT geohash FROM train WHERE day = {TGT} AND geohash IS NOT NULL
                              INTERSECT SELECT geohash FROM test WHERE day = {TGT} AND geohash IS NOT NULL)) AS overlap""", []))
def _aud_target_cells(spark, d):
    tr, te, days = raw(spark, d)
    a, b = tr.filter(F.col("day") == days.target_day), te.filter(F.col("day") == days.target_day)
    ov = prof.key_overlap(a.filter(F.col("geohash").isNotNull()), b.filter(F.col("geohash").isNotNull()), ["geohash"])
    return ov.select(F.col("left_keys").alias("train_cells"), F.col("right_keys").alias("test_cells"), "overlap")


@reg("aud_slots_per_cell", sql_finish(_describe_sql(
    "slots", f"(SELECT geohash, count(DISTINCT timestamp) AS slots FROM train WHERE day = {REF} AND geohash IS NOT NULL GROUP BY geohash)"),
    ["mean", "std", "q25", "q50", "q75"]))
def _aud_slots_per_cell(spark, d):
    tr, _, days = raw(spark, d)
    return prof.slots_per_cell(tr.filter(F.col("day") == days.ref_day))


# ---- scalar features (both frames) ---------------------------------------------------------------------------

FEATURE_QUERIES = {
    "feat_time_parse": (["timestamp", "hour", "minute", "total_minutes"], []),
    "feat_time_flags": (["hour", "peak_hour", "morning_peak", "evening_peak", "late_night", "midday"], []),
    "feat_time_cyclic": (["sin_hour", "cos_hour", "sin_minute", "cos_minute", "sin_total", "cos_total"],
                         ["sin_hour", "cos_hour", "sin_minute", "cos_minute", "sin_total", "cos_total"]),
    "feat_space_prefix": (["geohash", "gh_prefix4", "gh_prefix5", "gh_prefix6", "geohash_len"], []),
    "feat_cat_fill": (["RoadType", "Weather", "LargeVehicles", "Landmarks"], []),
    "feat_cat_ordinal": (["RoadType", "Weather", "road_type_ord", "weather_ord"], []),
    "feat_cat_binary": (["large_veh_bin", "landmarks_bin"], []),
    "feat_num_impute_median": (["NumberofLanes", "Temperature"], ["NumberofLanes", "Temperature"]),
    "feat_num_extreme": (["Temperature", "temp_extreme"], ["Temperature"]),
    "feat_num_band": (["Temperature", "temp_band"], ["Temperature", "temp_band"]),
    "feat_interactions": (["road_capacity", "road_capacity2", "road_x_hour", "lanes_x_hour", "lanes_x_peak",
                           "road_x_weather"], ["road_capacity", "road_capacity2", "lanes_x_hour", "lanes_x_peak"]),
    "feat_congestion_potential": (["congestion_potential"], ["congestion_potential"]),
}


def _feature_query(cols):
    return lambda spark, d: finish(both(base(spark, d), [ROW_KEY] + cols))


for _name, (_cols, _dbl) in FEATURE_QUERIES.items():
    Q[_name] = Query(_feature_query(_cols), sql_finish(sql_both(", ".join([ROW_KEY] + _cols)), _dbl), _dbl)


# ---- day pairs and lags -----------------------------------------------------------------------------------

PAIRS_SQL = ("SELECT a.day, a.geohash, a.timestamp, a.demand AS demand_target, b.demand AS demand_ref "
             "FROM train a JOIN train b ON a.geohash = b.geohash AND a.timestamp = b.timestamp AND b.day = a.day - 1")


def _pairs(spark, d):
    return day_pairs(raw(spark, d)[0])


Q["join_day_pairs"] = Query(lambda s, d: finish(_pairs(s, d)), sql_finish(PAIRS_SQL, ["demand_target", "demand_ref"]))
Q["lag_correlation"] = Query(
    lambda s, d: finish(_pairs(s, d).agg(F.count(F.lit(1)).alias("pairs"), F.corr("demand_target", "demand_ref").alias("pearson"))),
    sql_finish(f"SELECT count(*) AS pairs, corr(demand_target, demand_ref) AS pearson FROM ({PAIRS_SQL})", ["pearson"]))
Q["lag_baseline_r2"] = Query(
    lambda s, d: finish(_pairs(s, d).agg(F.count(F.lit(1)).alias("pairs"), r2("demand_target", "demand_ref").alias("r2"))),
    sql_finish(f"SELECT count(*) AS pairs, 1 - sum((demand_target - demand_ref) ^ 2) / "
               f"nullif(var_pop(demand_target) * count(demand_target), 0) AS r2 FROM ({PAIRS_SQL})", ["r2"]))

STATS = stat_names()
LAGS = lag_names()


def _ref(spark, d):
    fr = base(spark, d)
    return fr.train.filter(F.col("day") == fr.binding.ref_day)


Q["lag_cell_stats"] = Query(lambda s, d: finish(cell_stats(_ref(s, d)).select("geohash", *STATS[:4])),
                            sql_finish(f"SELECT geohash, {', '.join(STATS[:4])} FROM stats", STATS[:4], O.lag_ctes()))
Q["lag_cell_peaks"] = Query(lambda s, d: finish(cell_stats(_ref(s, d)).select("geohash", *STATS[4:])),
                            sql_finish(f"SELECT geohash, {', '.join(STATS[4:])} FROM stats", STATS[4:], O.lag_ctes()))


def _unmasked(spark, d):
    fr = base(spark, d)
    ref = fr.train.filter(F.col("day") == fr.binding.ref_day)
    t = lag_table(ref)
    return Frames(fr.train.join(t, ["geohash", "total_minutes"], "left"), fr.test.join(t, ["geohash", "total_minutes"], "left"))


def _unmasked_sql(cols) -> str:
    sel = ", ".join(cols)
    joins = "\n".join(f"LEFT JOIN ref r{i} ON r{i}.geohash = a.geohash AND r{i}.total_minutes = a.total_minutes + ({off})"
                      for i, off in enumerate([0] + O.OFFSETS))
    lag_cols = ", ".join(f"r{i}.demand AS {n}" for i, n in enumerate(LAGS))
    body = (f"SELECT frame, {sel} FROM (SELECT 'train' AS frame, a.Index, {lag_cols} FROM ftrain a {joins} "
            f"UNION ALL SELECT 'test' AS frame, a.Index, {lag_cols} FROM ftest a {joins})")
    return body


Q["lag_exact"] = Query(lambda s, d: finish(both(_unmasked(s, d), [ROW_KEY, LAGS[0]])),
                       sql_finish(_unmasked_sql([ROW_KEY, LAGS[0]]), [LAGS[0]], O.lag_ctes()))
Q["lag_offsets"] = Query(lambda s, d: finish(both(_unmasked(s, d), [ROW_KEY] + LAGS[1:])),
                         sql_finish(_unmasked_sql([ROW_KEY] + LAGS[1:]), LAGS[1:], O.lag_ctes()))
Q["lag_mask"] = Query(lambda s, d: finish(lagged(s, d).train.select(ROW_KEY, "day", *STATS, *LAGS)),
                      sql_finish(f"SELECT Index, day, {', '.join(STATS + LAGS)} FROM ltrain", STATS + LAGS, O.lag_ctes()))
Q["lag_imputed"] = Query(lambda s, d: finish(both(lagged(s, d), [ROW_KEY, IMPUTED])),
                         sql_finish(sql_both(f"Index, {IMPUTED}", "ltrain", "ltest"), [IMPUTED], O.lag_ctes()))


# ---- frequency, folds, encodings ------------------------------------------------------------------------------

FREQ = ["geohash_freq", "gh_prefix4_freq", "gh_prefix5_freq"]


def _freq_sql() -> str:
    def one(src):
        return (f"SELECT a.Index, coalesce(f1.n, 0) AS geohash_freq, coalesce(f2.n, 0) AS gh_prefix4_freq, "
                f"coalesce(f3.n, 0) AS gh_prefix5_freq FROM {src} a "
                f"LEFT JOIN (SELECT geohash AS k, count(*) AS n FROM ftrain WHERE geohash IS NOT NULL GROUP BY 1) f1 ON f1.k = a.geohash "
                f"LEFT JOIN (SELECT gh_prefix4 AS k, count(*) AS n FROM ftrain WHERE gh_prefix4 IS NOT NULL GROUP BY 1) f2 ON f2.k = a.gh_prefix4 "
                f"LEFT JOIN (SELECT gh_prefix5 AS k, count(*) AS n FROM ftrain WHERE gh_prefix5 IS NOT NULL GROUP BY 1) f3 ON f3.k = a.gh_prefix5")
    return f"SELECT 'train' AS frame, * FROM ({one('ftrain')}) UNION ALL SELECT 'test' AS frame, * FROM ({one('ftest')})"


def _freq(spark, d):
    fr = base(spark, d)
    tr, te = frequency_encode(fr.train, fr.test)
    return both(Frames(tr, te), [ROW_KEY] + FREQ)


Q["enc_frequency"] = Query(lambda s, d: finish(_freq(s, d)), sql_finish(_freq_sql(), []))
Q["fold_assign"] = Query(lambda s, d: finish(base(s, d).train.select(ROW_KEY, FOLD)),
                         sql_finish("SELECT Index, fold FROM ftrain", []))


def _specs(*names):
    return [s for s in ENCODING_SPECS if s.name in names]


TE_QUERIES = {
    "te_oof_mean": _specs("te__geohash__mean", "te__geohash__hour__mean", "te__RoadType__mean",
                          "te__geohash__Weather__hour__mean"),
    "te_oof_std": _specs("te__geohash__std", "te__geohash__hour__std"),
    "te_oof_max": _specs("te__geohash__max"),
    "te_oof_median": _specs("te__geohash__median"),
}


def _te_oof(specs):
    def fn(spark, d):
        fr = encoded(spark, d, specs, lags=False, narrow=True)
        return finish(fr.train.select(ROW_KEY, *fr.te_cols))
    return fn


for _name, _sp in TE_QUERIES.items():
    _names = [s.name for s in _sp]
    Q[_name] = Query(_te_oof(_sp), sql_finish(O.te_select(_sp, "ftrain", True), _names), _names)

TE_TEST = _specs("te__geohash__mean", "te__geohash__std", "te__geohash__max", "te__geohash__median",
                 "te__geohash__Weather__hour__mean")


def _te_test(spark, d):
    fr = encoded(spark, d, TE_TEST, lags=False, narrow=True)
    return finish(fr.test.select(ROW_KEY, *fr.te_cols))


Q["te_test_stats"] = Query(_te_test, sql_finish(O.te_select(TE_TEST, "ftest", False),
                                                [s.name for s in TE_TEST]))

ALL_TE = [s.name for s in ENCODING_SPECS]


def _te_all(spark, d):
    fr = encoded(spark, d, ENCODING_SPECS, lags=False, narrow=True)
    return finish(both(fr, [ROW_KEY] + fr.te_cols))


Q["te_all"] = Query(_te_all, sql_finish(
    O.te_select(ENCODING_SPECS, "ftrain", True, "'train' AS frame, ")
    + " UNION ALL " + O.te_select(ENCODING_SPECS, "ftest", False, "'test' AS frame, "), ALL_TE))


# ---- domain features ------------------------------------------------------------------------------------------

DOM_COLS = {
    "dom_lane_pressure": ["lane_pressure"],
    "dom_landmark_congestion": ["landmark_congestion"],
    "dom_weather_sensitivity": ["weather_sensitivity"],
    "dom_congestion_score": ["congestion_score"],
    "dom_cv": ["gh_cv"],
    "dom_rank_pct": ["gh_rank"],
    "dom_lag_features": ["lane_pressure_lag", "congestion_potential_lag"],
}


def _dom_frames(spark, d, lags: bool) -> Frames:
    fr = encoded(spark, d, O.DOM_SPECS, lags)
    return Frames(dom.domain_features(fr.train, lags), dom.domain_features(fr.test, lags))


def _dom_sql(cols, lags: bool) -> str:
    src_tr, src_te = ("ltrain", "ltest") if lags else ("ftrain", "ftest")
    ctes = (O.lag_ctes() + ",\n" if lags else "") + (
        f"etrain AS ({O.te_rows(O.DOM_SPECS, src_tr, True)}),\n"
        f"etest AS ({O.te_rows(O.DOM_SPECS, src_te, False)}),\n"
        f"dtrain AS ({O.lag_domain_select('(' + O.domain_select('etrain') + ')') if lags else O.domain_select('etrain')}),\n"
        f"dtest AS ({O.lag_domain_select('(' + O.domain_select('etest') + ')') if lags else O.domain_select('etest')})")
    return sql_finish(sql_both(", ".join([ROW_KEY] + cols), "dtrain", "dtest"), cols, ctes)


for _name, _cols in DOM_COLS.items():
    _lags = _name == "dom_lag_features"
    Q[_name] = Query((lambda c, l: lambda s, d: finish(both(_dom_frames(s, d, l), [ROW_KEY] + c)))(_cols, _lags),
                     _dom_sql(_cols, _lags), _cols)


# ---- feature matrix ---------------------------------------------------------------------------------------

NUM = numeric_features(2)
CAT = categorical_features(2)


def _matrix(spark, d, version=2):
    fr = build_features(spark, d, version=version)
    tr = feature_matrix(fr.train, version=version, with_target=True)
    te = feature_matrix(fr.test, version=version, with_target=False).withColumn(TARGET, F.lit(None).cast("double"))
    return tr.select(F.lit("train").alias("frame"), "*").unionByName(te.select(F.lit("test").alias("frame"), "*"))


def _matrix_cat(spark, d) -> DataFrame:
    """Mixed matrix of the categorical-aware learner: numeric features plus indexed categoricals (``StringIndexer``
    fitted on the labelled frame: by count, ties by name; unseen levels share an extra index), both frames."""
    both_ = cut_lineage(_matrix(spark, d))
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in CAT]
    return Pipeline(stages=stages).fit(both_.filter(F.col("frame") == "train")).transform(both_)


def _matrix_cat_sql() -> str:
    index = "".join(
        f" LEFT JOIN (SELECT {c} AS k{i}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i{i} FROM m WHERE frame = 'train' GROUP BY {c}) x{i} "
        f"ON x{i}.k{i} = m.{c}" for i, c in enumerate(CAT))
    cols = ", ".join(f"CAST(coalesce(i{i}, (SELECT count(DISTINCT {c}) FROM m WHERE frame = 'train')) AS DOUBLE) AS {c}__idx" for i, c in enumerate(CAT))
    return f"WITH m AS ({_matrix_sql()}) SELECT m.*, {cols} FROM m{index}"


def _matrix_sql(version=2) -> str:
    num_cols, cat_cols = numeric_features(version), categorical_features(version)
    num = ", ".join(f"coalesce(CAST({c} AS DOUBLE), -999.0::DOUBLE) AS {c}" for c in num_cols)
    cat = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-999') AS {c}" for c in cat_cols)
    body = (f"SELECT 'train' AS frame, Index, {num}, {cat}, demand FROM dtrain "
            f"UNION ALL SELECT 'test' AS frame, Index, {num}, {cat}, CAST(NULL AS DOUBLE) AS demand FROM dtest")
    return sql_finish(body, num_cols + [TARGET], O.full_v2_ctes() if version == 2 else O.full_v1_ctes())


Q["feature_matrix"] = Query(lambda s, d: finish(_matrix(s, d)), _matrix_sql(), NUM + [TARGET])
Q["feature_matrix_cat"] = Query(lambda s, d: finish(_matrix_cat(s, d)), _matrix_cat_sql(), NUM + [TARGET])
Q["feature_matrix_v1"] = Query(lambda s, d: finish(_matrix(s, d, 1)), _matrix_sql(1), numeric_features(1) + [TARGET])


# ---- ensemble search and error analysis on deterministic stand-in predictors ----------------------------------

def stand_in_predictions(spark, d) -> DataFrame:
    """Labelled rows with three leakage-safe predictors: p1 = out-of-fold cell-hour mean, p2 = out-of-fold
    cell mean, p3 = imputed reference-day lag."""
    fr = encoded(spark, d, O.ENS_SPECS, True)
    return fr.train.select(ROW_KEY, FOLD, "geohash", "hour", "RoadType", TARGET,
                           F.col("te__geohash__hour__mean").alias("p1"), F.col("te__geohash__mean").alias("p2"),
                           F.col(IMPUTED).alias("p3"))


ENS = O.ens_ctes()


def _stacked(spark, d) -> DataFrame:
    """The stand-in predictors in long form (one row for each key and predictor), stacked by the row key."""
    wide = cut_lineage(stand_in_predictions(spark, d).select(ROW_KEY, TARGET, *ens.PREDS))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("learner"), F.col(p).alias("prediction")) for p in ens.PREDS]))
    return ens.stack(wide.select(ROW_KEY, each.alias("_p")).select(ROW_KEY, "_p.*"), ens.PREDS, wide.select(ROW_KEY, TARGET))


Q["ens_stack"] = Query(lambda s, d: finish(_stacked(s, d)),
                       sql_finish("SELECT Index, demand, p1, p2, p3 FROM pred", ["demand", "p1", "p2", "p3"], ENS))


def _grid(spark, d):
    return ens.grid(ens.gram_stats(stand_in_predictions(spark, d), TARGET))


Q["ens_grid"] = Query(lambda s, d: finish(_grid(s, d)), sql_finish("SELECT w1, w2, w3, r2 FROM scores", ["w1", "w2", "w3", "r2"], ENS))
BEST_SQL = "SELECT w1, w2, w3, r2 FROM scores ORDER BY round(r2, 12) DESC, w1 DESC, w2 DESC, w3 DESC LIMIT 1"
Q["ens_grid_best"] = Query(lambda s, d: finish(ens.grid_best(_grid(s, d))), sql_finish(BEST_SQL, ["w1", "w2", "w3", "r2"], ENS))
Q["ens_weights"] = Query(lambda s, d: finish(ens.optimal_weights(ens.gram_stats(stand_in_predictions(s, d), TARGET))),
                         sql_finish(f"SELECT * FROM {O.weights_sql()}", ["w1", "w2", "w3", "r2"], ENS))


def _blended(spark, d) -> DataFrame:
    p = cut_lineage(stand_in_predictions(spark, d).select(ROW_KEY, TARGET, *ens.PREDS))
    return ens.blend(p, ens.grid_best(ens.grid(ens.gram_stats(p, TARGET)))).select(ROW_KEY, "blend", "blend_clipped")


Q["ens_blend"] = Query(
    lambda s, d: finish(_blended(s, d)),
    sql_finish("SELECT Index, b AS blend, CASE WHEN b IS NOT NULL THEN least(greatest(b, 0.0::DOUBLE), 1.0::DOUBLE) END AS blend_clipped "
               f"FROM (SELECT Index, w1 * p1 + w2 * p2 + w3 * p3 AS b FROM pred, ({BEST_SQL}))", ["blend", "blend_clipped"], ENS))


# scores of the three stand-in predictors by fold: what the model queries report of fitted learners

def _by_learner(spark, d, score) -> DataFrame:
    p = cut_lineage(stand_in_predictions(spark, d).select(ROW_KEY, FOLD, TARGET, *ens.PREDS))
    out = [score(p.select(ROW_KEY, FOLD, F.col(n).alias(cv.PREDICTION)), p).select(F.lit(n).alias("learner"), "*") for n in ens.PREDS]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _r2_sql(p: str) -> str:
    return f"1 - sum((demand - {p}) ^ 2) / nullif(var_pop(demand) * count(demand), 0)"


FOLD_SQL = " UNION ALL ".join(f"SELECT '{p}' AS learner, fold, {_r2_sql(p)} AS r2 FROM pred GROUP BY fold" for p in ens.PREDS)
Q["ens_fold_scores"] = Query(lambda s, d: finish(_by_learner(s, d, cv.fold_scores)), sql_finish(FOLD_SQL, ["r2"], ENS))
Q["ens_fold_summary"] = Query(
    lambda s, d: finish(_by_learner(s, d, cv.score_summary)),
    sql_finish(f"SELECT f.learner, any_value(o.oof_r2) AS oof_r2, avg(f.r2) AS fold_mean, stddev_pop(f.r2) AS fold_std FROM ({FOLD_SQL}) f JOIN ("
               + " UNION ALL ".join(f"SELECT '{p}' AS learner, {_r2_sql(p)} AS oof_r2 FROM pred" for p in ens.PREDS)
               + ") o ON o.learner = f.learner GROUP BY f.learner", ["oof_r2", "fold_mean", "fold_std"], ENS))


def _errors_frame(spark, d) -> DataFrame:
    """Stand-in predictions blended with the grid-best weights, then residual columns."""
    p = cut_lineage(stand_in_predictions(spark, d))
    best = ens.grid_best(ens.grid(ens.gram_stats(p, TARGET)))
    return err.residuals(ens.blend(p, best, clipped=None), "blend")


ERR_CTE = ENS + f""",
best AS ({BEST_SQL}),
res0 AS (SELECT p.*, CASE WHEN b.w1 * p.p1 + b.w2 * p.p2 + b.w3 * p.p3 IS NOT NULL THEN
           least(greatest(b.w1 * p.p1 + b.w2 * p.p2 + b.w3 * p.p3, 0.0::DOUBLE), 1.0::DOUBLE) END AS oof_pred
         FROM pred p, best b),
res AS (SELECT *, demand - oof_pred AS residual, abs(demand - oof_pred) AS abs_err FROM res0)"""

Q["err_residuals"] = Query(lambda s, d: finish(_errors_frame(s, d).select(ROW_KEY, "oof_pred", "residual", "abs_err")),
                           sql_finish("SELECT Index, oof_pred, residual, abs_err FROM res", ["oof_pred", "residual", "abs_err"], ERR_CTE))
Q["err_worst_cells"] = Query(lambda s, d: finish(err.worst_cells(_errors_frame(s, d))),
                             sql_finish("SELECT geohash, avg(abs_err) AS mae, count(abs_err) AS n FROM res GROUP BY geohash "
                                        "ORDER BY mae DESC, geohash ASC LIMIT 10", ["mae"], ERR_CTE))
Q["err_mae_by_hour"] = Query(lambda s, d: finish(err.mae_by(_errors_frame(s, d), "hour")),
                             sql_finish("SELECT hour, round(avg(abs_err), 5) AS mae FROM res GROUP BY hour ORDER BY hour", ["mae"], ERR_CTE))
Q["err_threshold_counts"] = Query(
    lambda s, d: finish(err.threshold_counts(_errors_frame(s, d))),
    sql_finish("SELECT count_if(abs_err > 0.10::DOUBLE) AS high_error, count_if(residual > 0.05::DOUBLE) AS under_predicted, "
               "count_if(residual < -0.05::DOUBLE) AS over_predicted FROM res", [], ERR_CTE))
Q["err_high_by_category"] = Query(
    lambda s, d: finish(err.high_error_by(_errors_frame(s, d), "RoadType")),
    sql_finish("SELECT RoadType, count(*) AS count FROM res WHERE abs_err > 0.10::DOUBLE AND RoadType IS NOT NULL "
               "GROUP BY RoadType ORDER BY count DESC, RoadType", [], ERR_CTE))


# ---- streaming ------------------------------------------------------------------------------------------------

def _stream_panel(spark, d):
    import uuid

    from demandspark.streaming.panel_stream import events_source_path, panel_stream, read_events_stream, run_to_table
    events = read_events_stream(spark, events_source_path(d))
    return finish(run_to_table(panel_stream(events, watermark=None), "panel_" + uuid.uuid4().hex[:12]))


Q["stream_panel"] = Query(_stream_panel, sql_finish(
    "SELECT * FROM panel", ["demand", "NumberofLanes", "Temperature"]), ["demand", "NumberofLanes", "Temperature"])
