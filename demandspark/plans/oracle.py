"""DuckDB oracle SQL for the query catalog.

Written from the semantics (row-level definitions: correlated subqueries over the other folds, direct
self-joins, direct R² per grid point), not from the Spark plans, so a shared mistake is unlikely. Tables
``events`` etc. are views registered by the checker. Literals are cast to DOUBLE (DuckDB decimal literals
would change arithmetic), and every double output is rounded to 9 digits (+0.0 folds -0.0) as on the Spark side.
"""

from __future__ import annotations

from typing import NamedTuple


class Spec(NamedTuple):
    """One encoding: its key columns and its aggregate."""

    keys: tuple
    agg: str

    @property
    def name(self) -> str:
        return f"te__{'__'.join(self.keys)}__{self.agg}"


# Fixed values, stated here again so that a wrong list in the operators shows up as a difference.
ENCODING_SPECS = [Spec(tuple(text.split()[:-1]), text.split()[-1]) for text in (
    "geohash mean", "geohash std", "geohash max", "geohash median",
    "gh_prefix4 mean", "gh_prefix5 mean", "gh_prefix6 mean",
    "RoadType mean", "Weather mean", "NumberofLanes mean",
    "geohash hour mean", "geohash hour std", "geohash day mean", "geohash Weather mean",
    "geohash peak_hour mean", "geohash morning_peak mean", "geohash evening_peak mean",
    "geohash landmarks_bin mean", "geohash large_veh_bin mean", "geohash NumberofLanes mean",
    "gh_prefix4 hour mean", "gh_prefix4 day mean", "gh_prefix4 Weather mean",
    "gh_prefix5 hour mean", "gh_prefix5 day mean", "gh_prefix6 hour mean",
    "RoadType hour mean", "RoadType Weather mean", "RoadType peak_hour mean",
    "Weather hour mean", "Weather large_veh_bin mean", "road_type_ord hour mean",
    "geohash Weather hour mean", "gh_prefix4 hour Weather mean")]
OFFSETS = [-60, -45, -30, -15, 15, 30, 45, 60]
LAGS = ["demand_lag_1day", "demand_lag_1day_offset_m60", "demand_lag_1day_offset_m45", "demand_lag_1day_offset_m30",
        "demand_lag_1day_offset_m15", "demand_lag_1day_offset_15", "demand_lag_1day_offset_30", "demand_lag_1day_offset_45",
        "demand_lag_1day_offset_60"]
STATS = ["gh_day48_mean", "gh_day48_std", "gh_day48_max", "gh_day48_min", "gh_day48_peak_mean", "gh_day48_morning_peak_mean",
         "gh_day48_evening_peak_mean"]

PANEL = """
select lower(to_base(u, 32, 6)) as geohash,
       cast(dy as int) as day,
       concat(cast(cast(floor(m / 60) as int) as string), ':', lpad(cast(m % 60 as string), 2, '0')) as timestamp,
       least(avg(value) / 500, cast(1 as double)) as demand,
       case min(event_type) when 'click' then 'Highway' when 'error' then 'Street'
                            when 'purchase' then 'Residential' when 'signup' then 'Alley' end as RoadType,
       case min(k) % 6 when 0 then 'Sunny' when 1 then 'Foggy' when 2 then 'Rainy'
                       when 3 then 'Snowy' when 4 then 'Windy' end as Weather,
       case min(user_id) % 3 when 0 then 'Allowed' when 1 then 'Not Allowed' end as LargeVehicles,
       case max(user_id) % 3 when 0 then 'Yes' when 1 then 'No' end as Landmarks,
       cast(nullif(max(k) % 6, 0) as double) as NumberofLanes,
       case when min(k) % 11 <> 0 then cast(min(k) * 2 - 60 as double) end as Temperature,
       min(event_id) as Index
from (select event_id, event_type, value, user_id, user_id // 10 as u, date_diff('day', DATE '2024-01-01', cast(ts as date)) + 1 as dy,
             cast(hour(ts) * 60 + floor(minute(ts) / 15) * 15 as int) as m,
             cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
      from events) e
group by u, dy, m
"""

H = "CAST(string_split(timestamp, ':')[1] AS INTEGER)"
M = "CASE WHEN len(string_split(timestamp, ':')) > 1 THEN CAST(string_split(timestamp, ':')[2] AS INTEGER) ELSE 0 END"
D = "::DOUBLE"
FOLD = "CAST(('0x' || substr(md5('42:' || CAST(Index AS VARCHAR)), 1, 8))::BIGINT % 5 AS INTEGER)"

#: The target day is the last day of the data, the reference day the one before.
TGT = "(SELECT target_day FROM days)"
REF = "(SELECT ref_day FROM days)"

RAW = ["geohash", "day", "timestamp", "demand", "RoadType", "Weather", "LargeVehicles", "Landmarks",
       "NumberofLanes", "Temperature", "Index"]


def _features(src: str) -> str:
    """Base features of frame ``src`` (a CTE name) in three projections."""
    return f"""(
SELECT *,
  NumberofLanes * large_veh_bin AS road_capacity,
  NumberofLanes * road_type_ord AS road_capacity2,
  road_type_ord * 0.4{D} + NumberofLanes * 0.3{D} + landmarks_bin * 0.2{D} + peak_hour * 0.1{D} AS congestion_potential,
  road_type_ord * hour AS road_x_hour,
  NumberofLanes * hour AS lanes_x_hour,
  NumberofLanes * peak_hour AS lanes_x_peak,
  road_type_ord * weather_ord AS road_x_weather
FROM (
  SELECT *,
    hour * 60 + minute AS total_minutes,
    CAST((hour BETWEEN 7 AND 9) OR (hour BETWEEN 17 AND 19) AS INTEGER) AS peak_hour,
    CAST(hour BETWEEN 7 AND 9 AS INTEGER) AS morning_peak,
    CAST(hour BETWEEN 17 AND 19 AS INTEGER) AS evening_peak,
    CAST(hour >= 23 OR hour <= 4 AS INTEGER) AS late_night,
    CAST(hour BETWEEN 11 AND 14 AS INTEGER) AS midday,
    sin(2 * pi() * hour / 24{D}) AS sin_hour, cos(2 * pi() * hour / 24{D}) AS cos_hour,
    sin(2 * pi() * minute / 60{D}) AS sin_minute, cos(2 * pi() * minute / 60{D}) AS cos_minute,
    sin(2 * pi() * (hour * 60 + minute) / 1440{D}) AS sin_total,
    cos(2 * pi() * (hour * 60 + minute) / 1440{D}) AS cos_total,
    substring(geohash, 1, 4) AS gh_prefix4, substring(geohash, 1, 5) AS gh_prefix5,
    substring(geohash, 1, 6) AS gh_prefix6, CAST(length(geohash) AS INTEGER) AS geohash_len,
    CASE RoadType WHEN 'Highway' THEN 4 WHEN 'Street' THEN 3 WHEN 'Residential' THEN 2
                  WHEN 'Unknown' THEN 1 ELSE 1 END AS road_type_ord,
    CASE Weather WHEN 'Sunny' THEN 4 WHEN 'Foggy' THEN 3 WHEN 'Rainy' THEN 2
                 WHEN 'Snowy' THEN 1 WHEN 'Unknown' THEN 0 ELSE 0 END AS weather_ord,
    CAST(LargeVehicles = 'Allowed' AS INTEGER) AS large_veh_bin,
    CAST(Landmarks = 'Yes' AS INTEGER) AS landmarks_bin,
    CAST(coalesce(Temperature > 35 OR Temperature < 0, false) AS INTEGER) AS temp_extreme,
    CASE WHEN Temperature > -100 AND Temperature <= 0 THEN 0{D} WHEN Temperature > 0 AND Temperature <= 10 THEN 1{D}
         WHEN Temperature > 10 AND Temperature <= 20 THEN 2{D} WHEN Temperature > 20 AND Temperature <= 30 THEN 3{D}
         WHEN Temperature > 30 AND Temperature <= 100 THEN 4{D} ELSE 2{D} END AS temp_band
  FROM (
    SELECT * REPLACE (
        coalesce(RoadType, 'Unknown') AS RoadType, coalesce(Weather, 'Unknown') AS Weather,
        coalesce(LargeVehicles, 'Unknown') AS LargeVehicles, coalesce(Landmarks, 'Unknown') AS Landmarks,
        coalesce(NumberofLanes, (SELECT quantile_cont(NumberofLanes, 0.5) FROM {src})) AS NumberofLanes,
        coalesce(Temperature, (SELECT quantile_cont(Temperature, 0.5) FROM {src})) AS Temperature),
      {H} AS hour, {M} AS minute
    FROM {src}
  )
))"""


def base_ctes() -> str:
    raw_test = ", ".join(c for c in RAW if c != "demand")
    return f"""panel AS ({PANEL}),
days AS (SELECT max(day) AS target_day, max(day) - 1 AS ref_day FROM panel),
pp AS (SELECT *, {H} * 60 + {M} AS _tm FROM panel),
train AS (SELECT {", ".join(RAW)} FROM pp
          WHERE day <= {REF} OR (day = {TGT} AND _tm < 135)),
test AS (SELECT {raw_test} FROM pp WHERE day = {TGT} AND _tm BETWEEN 135 AND 825),
ftrain AS (SELECT *, {FOLD} AS fold FROM {_features("train")}),
ftest AS (SELECT * FROM {_features("test")}),
gm AS (SELECT avg(demand) AS gm FROM train)"""


def with_base(body: str, extra_ctes: str = "") -> str:
    ctes = base_ctes() + ((",\n" + extra_ctes) if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


# ---- lag CTEs -------------------------------------------------------------------------------------------

def lag_ctes(fallback: str = "0.09394::DOUBLE", src_train: str = "ftrain", src_test: str = "ftest") -> str:
    s = STATS
    stats = f"""ref AS (SELECT * FROM ftrain WHERE day = {REF}),
stats AS (SELECT geohash, avg(demand) AS {s[0]}, stddev_samp(demand) AS {s[1]}, max(demand) AS {s[2]},
                 min(demand) AS {s[3]},
                 avg(CASE WHEN hour IN (7, 8, 9, 17, 18, 19) THEN demand END) AS {s[4]},
                 avg(CASE WHEN hour IN (7, 8, 9) THEN demand END) AS {s[5]},
                 avg(CASE WHEN hour IN (17, 18, 19) THEN demand END) AS {s[6]}
          FROM ref WHERE geohash IS NOT NULL GROUP BY geohash)"""

    def lagged(src: str, masked: bool) -> str:
        joins, cols = [], []
        for i, (off, name) in enumerate(zip([0] + OFFSETS, LAGS)):
            joins.append(f"LEFT JOIN ref r{i} ON r{i}.geohash = a.geohash AND r{i}.total_minutes = a.total_minutes + ({off})")
            cols.append((f"r{i}.demand", name))
        all_cols = [(f"st.{c}", c) for c in s] + cols
        if masked:
            sel = ", ".join(f"CASE WHEN a.day <> {REF} THEN {e} END AS {n}" for e, n in all_cols)
        else:
            sel = ", ".join(f"{e} AS {n}" for e, n in all_cols)
        return f"""SELECT a.*, {sel}
FROM {src} a LEFT JOIN stats st ON st.geohash = a.geohash
{chr(10).join(joins)}"""

    return f"""{stats},
ltrain0 AS ({lagged(src_train, True)}),
ltest0 AS ({lagged(src_test, False)}),
ltrain AS (SELECT *, coalesce(demand_lag_1day, {s[0]}, {fallback}) AS demand_lag_1day_imputed FROM ltrain0),
ltest AS (SELECT *, coalesce(demand_lag_1day, {s[0]}, {fallback}) AS demand_lag_1day_imputed FROM ltest0)"""


# ---- target encodings ----------------------------------------------------------------------------------

AGG_SQL = {"mean": "avg(b.demand)", "std": "stddev_samp(b.demand)", "max": "max(b.demand)",
           "median": "quantile_cont(b.demand, 0.5)"}


def te_rows(specs, src: str, oof: bool) -> str:
    """``src`` with one column per encoding: a group-by per key set (and held fold), joined back on the keys."""
    joins, cols = [], []
    for i, s in enumerate(specs):
        keys = ", ".join(f"b.{k}" for k in s.keys)
        match = " AND ".join(f"t{i}.{k} IS NOT DISTINCT FROM a.{k}" for k in s.keys)
        if oof:
            table = (f"SELECT {keys}, h.held, {AGG_SQL[s.agg]} AS v FROM ftrain b "
                     f"JOIN (SELECT unnest(range(5)) AS held) h ON b.fold <> h.held GROUP BY {keys}, h.held")
            match += f" AND t{i}.held = a.fold"
        else:
            table = f"SELECT {keys}, {AGG_SQL[s.agg]} AS v FROM ftrain b GROUP BY {keys}"
        joins.append(f"LEFT JOIN ({table}) t{i} ON {match}")
        cols.append(f"coalesce(t{i}.v, (SELECT gm FROM gm)) AS {s.name}")
    return f"SELECT a.*, {', '.join(cols)} FROM {src} a {' '.join(joins)}"


def te_select(specs, src: str, oof: bool, prefix: str = "") -> str:
    """Only the row key and the encodings (and the constants of ``prefix``)."""
    return f"SELECT {prefix}Index, {', '.join(s.name for s in specs)} FROM ({te_rows(specs, src, oof)})"


# ---- domain ---------------------------------------------------------------------------------------------

def domain_select(te_src: str) -> str:
    """Projection over a frame with te columns (and lag columns when present in ``te_src``)."""
    return f"""SELECT *,
  te__geohash__mean / (NumberofLanes + 1e-6) AS lane_pressure,
  landmarks_bin * te__geohash__hour__mean * (1 + peak_hour) AS landmark_congestion,
  CASE WHEN te__geohash__Weather__mean / (te__geohash__mean + 1e-9) IS NOT NULL
       THEN least(greatest(te__geohash__Weather__mean / (te__geohash__mean + 1e-9), 0.0{D}), 5.0{D}) END AS weather_sensitivity,
  te__geohash__hour__mean * 0.40{D} + (te__geohash__mean / (NumberofLanes + 1e-6)) * 0.30{D}
    + (landmarks_bin * te__geohash__hour__mean * (1 + peak_hour)) * 0.20{D} + congestion_potential * 0.10{D} AS congestion_score,
  CASE WHEN te__geohash__std / (te__geohash__mean + 1e-9) IS NOT NULL
       THEN least(greatest(te__geohash__std / (te__geohash__mean + 1e-9), 0.0{D}), 10.0{D}) END AS gh_cv,
  CASE WHEN te__geohash__mean IS NOT NULL THEN
    (rank() OVER (ORDER BY te__geohash__mean) + (count(*) OVER (PARTITION BY te__geohash__mean) - 1) / 2)
    / count(te__geohash__mean) OVER () END AS gh_rank
FROM {te_src}"""


def lag_domain_select(src: str) -> str:
    return f"""SELECT *,
  demand_lag_1day_imputed / (NumberofLanes + 1e-6) AS lane_pressure_lag,
  road_type_ord * 0.3{D} + NumberofLanes * 0.2{D} + demand_lag_1day_imputed * 0.4{D} + peak_hour * 0.1{D} AS congestion_potential_lag
FROM {src}"""


DOM_SPECS = [s for s in ENCODING_SPECS if s.name in
             ("te__geohash__mean", "te__geohash__std", "te__geohash__hour__mean", "te__geohash__Weather__mean")]
ENS_SPECS = [s for s in ENCODING_SPECS if s.name in ("te__geohash__mean", "te__geohash__hour__mean")]


def freq_select(src: str) -> str:
    return (f"SELECT a.*, coalesce(f1.n, 0) AS geohash_freq, coalesce(f2.n, 0) AS gh_prefix4_freq, "
            f"coalesce(f3.n, 0) AS gh_prefix5_freq FROM {src} a "
            f"LEFT JOIN (SELECT geohash AS k, count(*) AS n FROM ftrain WHERE geohash IS NOT NULL GROUP BY 1) f1 ON f1.k = a.geohash "
            f"LEFT JOIN (SELECT gh_prefix4 AS k, count(*) AS n FROM ftrain WHERE gh_prefix4 IS NOT NULL GROUP BY 1) f2 ON f2.k = a.gh_prefix4 "
            f"LEFT JOIN (SELECT gh_prefix5 AS k, count(*) AS n FROM ftrain WHERE gh_prefix5 IS NOT NULL GROUP BY 1) f3 ON f3.k = a.gh_prefix5")


def full_v2_ctes() -> str:
    """frequency + lag CTEs + OOF encodings + domain features for both frames (all 34 encodings)."""
    return f"qtrain AS ({freq_select('ftrain')}),\nqtest AS ({freq_select('ftest')}),\n" + lag_ctes(
        src_train="qtrain", src_test="qtest") + f""",
etrain AS ({te_rows(ENCODING_SPECS, 'ltrain', True)}),
etest AS ({te_rows(ENCODING_SPECS, 'ltest', False)}),
dtrain AS ({lag_domain_select(f"({domain_select('etrain')})")}),
dtest AS ({lag_domain_select(f"({domain_select('etest')})")})"""


def ens_ctes() -> str:
    """Labelled rows with the three deterministic stand-in predictors p1..p3."""
    return lag_ctes() + f""",
pred AS (SELECT Index, fold, geohash, hour, RoadType, demand, te__geohash__hour__mean AS p1, te__geohash__mean AS p2,
                demand_lag_1day_imputed AS p3
         FROM ({te_rows(ENS_SPECS, 'ltrain', True)})),
grid AS (SELECT i / 20 AS w1, j / 20 AS w2, (20 - i - j) / 20 AS w3
         FROM range(0, 21) gi(i), range(0, 21) gj(j) WHERE i + j <= 20),
scores AS (SELECT g.w1, g.w2, g.w3,
                  1 - sum((p.demand - (g.w1 * p.p1 + g.w2 * p.p2 + g.w3 * p.p3)) ^ 2)
                      / (var_pop(p.demand) * count(p.demand)) AS r2
           FROM grid g, pred p GROUP BY g.w1, g.w2, g.w3)"""


def weights_sql(src: str = "pred") -> str:
    """The best weights on the simplex: the least squares optimum of each of its 7 faces, written out from the sums of
    products of residuals, and the best of those that have no negative weight."""
    g = ", ".join(f"sum((p{i} - demand) * (p{j} - demand)) AS g{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3))
    faces = [f"SELECT {', '.join(('1.0' if i == k else '0.0') + D + f' AS w{k}' for k in (1, 2, 3))} FROM gram" for i in (1, 2, 3)]
    for i, j in ((1, 2), (1, 3), (2, 3)):
        den = f"(g{i}{i} + g{j}{j} - 2 * g{i}{j})"
        w = {i: f"(g{j}{j} - g{i}{j}) / {den}", j: f"(g{i}{i} - g{i}{j}) / {den}"}
        faces.append(f"SELECT {', '.join(w.get(k, '0.0' + D) + f' AS w{k}' for k in (1, 2, 3))} FROM gram WHERE {den} > 0")
    c = {1: "(g22 * g33 - g23 * g23) - (g12 * g33 - g13 * g23) + (g12 * g23 - g13 * g22)",
         2: "-(g12 * g33 - g13 * g23) + (g11 * g33 - g13 * g13) - (g11 * g23 - g12 * g13)",
         3: "(g12 * g23 - g13 * g22) - (g11 * g23 - g12 * g13) + (g11 * g22 - g12 * g12)"}
    whole = " + ".join(f"({x})" for x in c.values())
    faces.append(f"SELECT {', '.join(f'({c[k]}) / ({whole}) AS w{k}' for k in (1, 2, 3))} FROM gram WHERE ({whole}) > 0")
    quad = " + ".join(f"w{i} * w{j} * g{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3))
    return f"""(WITH gram AS (SELECT {g}, var_pop(demand) * count(demand) AS sstot FROM {src}),
faces AS ({' UNION ALL '.join(faces)})
SELECT w1, w2, w3, 1 - ({quad}) / sstot AS r2 FROM faces, gram WHERE w1 >= 0 AND w2 >= 0 AND w3 >= 0
ORDER BY round(r2, 12) DESC, w1 DESC, w2 DESC LIMIT 1)"""


def full_v1_ctes() -> str:
    """v1 flow: frequency + OOF encodings + domain features (no reference-day lags)."""
    return f"""qtrain AS ({freq_select('ftrain')}),
qtest AS ({freq_select('ftest')}),
etrain AS ({te_rows(ENCODING_SPECS, 'qtrain', True)}),
etest AS ({te_rows(ENCODING_SPECS, 'qtest', False)}),
dtrain AS ({domain_select('etrain')}),
dtest AS ({domain_select('etest')})"""
