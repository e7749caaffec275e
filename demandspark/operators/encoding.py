"""Leakage-safe out-of-fold target encodings.

For a key set K and a row in fold f, the encoding is an aggregate of the target over the labelled rows with
the same K in the *other* folds; the unlabelled frame uses all labelled rows. Missing (unseen key, or a std
over one row) falls back to the labelled frame's global target mean.

Key sets form a lattice, and only its top reads rows:

* **Finest grain.** One aggregate of the rows by all keys and the fold: count, sum and maximum of the target.
* **Anchors.** A few wide key sets (``ANCHORS``) that hold all others, each merged from the finest grain. A key set
  belongs to the first anchor that holds its keys, or the keys that determine them (``DEPENDS``).
* **Key sets.** Each merges from its anchor's partials into one row of per-fold sums for each of its keys, and from
  these into one array of values: of all folds, and without fold 0, 1, ...
* **Lookup.** The arrays are brought back to the anchors' keys, so that rows join one table for each anchor (four,
  whatever the number of encodings) and pick by their fold. The anchor without a cell is small and bounded by the
  categories; the rows move at most three times, however large the tables are.

Second moments do not merge by plain sums without losing digits: ``std`` partials (mean and squared deviations by
fold) come from the rows, for the key sets that ask for them only, and combine by the parallel formula. Medians use the
exact quantiles of ``order_stats`` on summed value histograms.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.metrics import N_FOLDS, hash_fold
from demandspark.operators.order_stats import exact_quantiles
from demandspark.sources.schemas import ROW_KEY, TARGET

log = logging.getLogger(__name__)

FOLD = "fold"
HELD = "_held"
#: Mean, deviation, maximum and median of the target, and the mean drawn towards the global one.
AGGS = ("mean", "std", "max", "median", "smooth")
#: Rows at the global mean that ``smooth`` adds to each key.
SMOOTH_ROWS = 1.0


@dataclass(frozen=True)
class EncodingSpec:
    keys: tuple[str, ...]
    agg: str

    @property
    def name(self) -> str:
        return "te__" + "__".join(self.keys) + "__" + self.agg


def _spec(keys, agg) -> EncodingSpec:
    return EncodingSpec(tuple([keys] if isinstance(keys, str) else keys), agg)


# The 34 encodings (keys, aggregate) in their reference order.
ENCODING_SPECS = [_spec(k, a) for k, a in [
    ("geohash", "mean"),
    ("geohash", "std"),
    ("geohash", "max"),
    ("geohash", "median"),
    ("gh_prefix4", "mean"),
    ("gh_prefix5", "mean"),
    ("gh_prefix6", "mean"),
    ("RoadType", "mean"),
    ("Weather", "mean"),
    ("NumberofLanes", "mean"),
    (["geohash", "hour"], "mean"),
    (["geohash", "hour"], "std"),
    (["geohash", "day"], "mean"),
    (["geohash", "Weather"], "mean"),
    (["geohash", "peak_hour"], "mean"),
    (["geohash", "morning_peak"], "mean"),
    (["geohash", "evening_peak"], "mean"),
    (["geohash", "landmarks_bin"], "mean"),
    (["geohash", "large_veh_bin"], "mean"),
    (["geohash", "NumberofLanes"], "mean"),
    (["gh_prefix4", "hour"], "mean"),
    (["gh_prefix4", "day"], "mean"),
    (["gh_prefix4", "Weather"], "mean"),
    (["gh_prefix5", "hour"], "mean"),
    (["gh_prefix5", "day"], "mean"),
    (["gh_prefix6", "hour"], "mean"),
    (["RoadType", "hour"], "mean"),
    (["RoadType", "Weather"], "mean"),
    (["RoadType", "peak_hour"], "mean"),
    (["Weather", "hour"], "mean"),
    (["Weather", "large_veh_bin"], "mean"),
    (["road_type_ord", "hour"], "mean"),
    (["geohash", "Weather", "hour"], "mean"),
    (["gh_prefix4", "hour", "Weather"], "mean"),
]]


def add_fold(df: DataFrame, key: str = ROW_KEY, n_folds: int = N_FOLDS) -> DataFrame:
    return df.withColumn(FOLD, hash_fold(key, n_folds))


def global_mean(train: DataFrame, target: str = TARGET) -> Column:
    return train.select(F.avg(target)).scalar()


def _name(keys, agg) -> str:
    return EncodingSpec(tuple(keys), agg).name


ALL_FOLDS = -1

# Columns that another column determines, and the anchors that lookups go through, narrowest domain first.
DEPENDS = {"gh_prefix4": "geohash", "gh_prefix5": "geohash", "gh_prefix6": "geohash", "peak_hour": "hour",
           "morning_peak": "hour", "evening_peak": "hour", "road_type_ord": "RoadType"}
ANCHORS = [
    ("RoadType", "Weather", "hour", "large_veh_bin", "NumberofLanes"),
    ("geohash", "Weather", "hour"),
    ("geohash", "day"),
    ("geohash", "NumberofLanes", "landmarks_bin", "large_veh_bin"),
]


@dataclass
class Anchor:
    """Key columns that rows are looked up by, and the specs (by their place) that are looked up there."""

    keys: list[str]
    specs: list[int]


def assign_anchors(specs) -> list[Anchor]:
    """Each spec to the first of ``ANCHORS`` that holds its keys; specs that none holds share one anchor for each set
    of determining keys. An anchor has the keys that its specs use and no others, so that nothing rests on
    ``DEPENDS`` but the number of its rows."""
    found: dict[frozenset, Anchor] = {}
    for i, s in enumerate(specs):
        roots = frozenset(DEPENDS.get(k, k) for k in s.keys)
        home = next((frozenset(a) for a in ANCHORS if roots <= set(a)), roots)
        anchor = found.setdefault(home, Anchor([], []))
        anchor.keys += [k for k in s.keys if k not in anchor.keys]
        anchor.specs.append(i)
    order = {frozenset(a): i for i, a in enumerate(ANCHORS)}
    return [found[a] for a in sorted(found, key=lambda a: order.get(a, len(order)))]


def bounded(anchor: Anchor) -> bool:
    """Whether the categories bound the anchor's rows, however many cells and days there are."""
    return {DEPENDS.get(k, k) for k in anchor.keys} <= set(ANCHORS[0])


def _key(s: EncodingSpec) -> Column:
    """The key of a row under one spec as text: null keys are left out of it, so they differ from any value."""
    return F.to_json(F.struct(*s.keys))


def _spec_keys(specs, places) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("spec"), _key(specs[i]).alias("key")) for i in places]))


def _by_fold(n_folds: int, value) -> Column:
    """array: value(all folds), value(without fold 0), value(without fold 1), ..."""
    every = list(range(n_folds))
    return F.array(*[value([f for f in every if f != held]) for held in [None, *every]])


def _total(cols) -> Column:
    out = F.lit(0.0)
    for c in cols:
        out = out + F.coalesce(c, F.lit(0.0))
    return out


def finest_partials(rows: DataFrame, keys, target: str) -> DataFrame:
    """One row for each combination of all ``keys`` and fold: _n, _s, _x (count, sum and maximum of the target)."""
    return rows.groupBy(*keys, FOLD).agg(F.count(target).alias("_n"), F.sum(target).alias("_s"), F.max(target).alias("_x"))


def anchor_partials(finest: DataFrame, anchors: list[Anchor], keys) -> DataFrame:
    """The partials of each anchor (``_anchor``), merged from the finest grain; keys of other anchors are null."""
    types = {f.name: f.dataType for f in finest.schema.fields}
    copies = F.array(*[F.struct(F.lit(i).alias("_anchor"), *[(F.col(k) if k in a.keys else F.lit(None).cast(types[k])).alias(k) for k in keys])
                       for i, a in enumerate(anchors)])
    x = finest.select(F.explode(copies).alias("_c"), FOLD, "_n", "_s", "_x").select("_c.*", FOLD, "_n", "_s", "_x")
    return x.groupBy("_anchor", *keys, FOLD).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.max("_x").alias("_x"))


def _at_anchors(anchors: list[Anchor], specs, wanted) -> Column:
    """(spec, key) of each of the ``wanted`` specs that a row of the anchors' table holds."""
    out = None
    for i, a in enumerate(anchors):
        places = [p for p in a.specs if p in wanted]
        here = F.array(*[F.struct(F.lit(p).alias("spec"), _key(specs[p]).alias("key")) for p in places])
        here = here if places else F.array().cast("array<struct<spec:int,key:string>>")
        out = F.when(F.col("_anchor") == i, here) if out is None else out.when(F.col("_anchor") == i, here)
    return F.explode(out)


def merged_stats(partials: DataFrame, anchors: list[Anchor], specs, n_folds: int) -> DataFrame:
    """spec, key, values of the means (plain and smoothed) and maxima, merged from the anchors' partials."""
    wanted = {i for i, s in enumerate(specs) if s.agg in ("mean", "max", "smooth")}
    x = partials.select(_at_anchors(anchors, specs, wanted).alias("_k"), FOLD, "_n", "_s", "_x").select("_k.*", FOLD, "_n", "_s", "_x")
    per_fold = [f(F.when(F.col(FOLD) == i, F.col(c))).alias(f"{c}{i}") for i in range(n_folds)
                for c, f in (("_n", F.sum), ("_s", F.sum), ("_x", F.max))]
    x = x.groupBy("spec", "key").agg(*per_fold)
    mean = _by_fold(n_folds, lambda fs: F.try_divide(_total(F.col(f"_s{f}") for f in fs), _total(F.col(f"_n{f}") for f in fs)))
    top = _by_fold(n_folds, lambda fs: F.greatest(*[F.col(f"_x{f}") for f in fs]) if len(fs) > 1 else F.col(f"_x{fs[0]}"))
    values = mean
    if maxima := [i for i in wanted if specs[i].agg == "max"]:
        values = F.when(F.col("spec").isin(maxima), top).otherwise(values)
    if smoothed := [i for i in wanted if specs[i].agg == "smooth"]:
        # every target is in one partial of each anchor
        overall = partials.filter(F.col("_anchor") == 0).select(F.try_divide(F.sum("_s"), F.sum("_n"))).scalar()
        smooth = _by_fold(n_folds, lambda fs: (_total(F.col(f"_s{f}") for f in fs) + SMOOTH_ROWS * overall)
                          / (_total(F.col(f"_n{f}") for f in fs) + SMOOTH_ROWS))
        values = F.when(F.col("spec").isin(smoothed), smooth).otherwise(values)
    return x.select("spec", "key", values.alias("values"))


def spread_stats(rows: DataFrame, specs, target: str, n_folds: int) -> DataFrame:
    """spec, key, values of the standard deviations (ddof 1), from the rows: per fold by Spark's own stable
    aggregate, over folds by the parallel formula."""
    wanted = [i for i, s in enumerate(specs) if s.agg == "std"]
    x = rows.select(_spec_keys(specs, wanted).alias("_k"), FOLD, target).select("_k.*", FOLD, target)
    y = [F.when(F.col(FOLD) == i, F.col(target)) for i in range(n_folds)]
    x = x.groupBy("spec", "key").agg(*[f(v).alias(f"{c}{i}") for i, v in enumerate(y)
                                       for c, f in (("_n", F.count), ("_m", F.avg), ("_v", F.var_pop))])

    def std(fs):
        n = _total(F.col(f"_n{f}") for f in fs)
        mean = F.try_divide(_total(F.col(f"_n{f}") * F.col(f"_m{f}") for f in fs), n)
        m2 = _total(F.col(f"_n{f}") * (F.col(f"_v{f}") + (F.col(f"_m{f}") - mean) * (F.col(f"_m{f}") - mean)) for f in fs)
        return F.when(n > 1, F.sqrt(m2 / (n - 1)))

    return x.select("spec", "key", _by_fold(n_folds, std).alias("values"))


def median_stats(rows: DataFrame, spec: int, s: EncodingSpec, target: str, n_folds: int) -> DataFrame:
    """spec, key, values of one median encoding."""
    table = median_table(rows, s.keys, target, n_folds).groupBy(*s.keys).agg(
        F.map_from_entries(F.collect_list(F.struct(HELD, s.name))).alias("_m"))
    at = F.array(*[F.try_element_at("_m", F.lit(h)) for h in [ALL_FOLDS, *range(n_folds)]])
    return table.select(F.lit(spec).alias("spec"), _key(s).alias("key"), at.alias("values"))


def anchor_tables(rows: DataFrame, specs, target: str = TARGET, n_folds: int = N_FOLDS) -> list[tuple[Anchor, DataFrame]]:
    """For each anchor the table that ``rows`` are looked up in: its keys and, for each of its specs, the array of values,
    with the global mean where there is none."""
    from demandspark.session import cut_lineage

    anchors = assign_anchors(specs)
    keys = list(dict.fromkeys(k for a in anchors for k in a.keys))
    finest = cut_lineage(finest_partials(rows, keys, target))
    partials = cut_lineage(anchor_partials(finest, anchors, keys))
    if log.isEnabledFor(logging.INFO):
        log.info("encodings: %d finest partials, by anchor %s", finest.count(), {
            r["_anchor"]: r["count"] for r in partials.groupBy("_anchor").count().collect()})
    parts = []
    if any(s.agg in ("mean", "max", "smooth") for s in specs):
        parts.append(merged_stats(partials, anchors, specs, n_folds))
    if any(s.agg == "std" for s in specs):
        parts.append(spread_stats(rows, specs, target, n_folds))
    parts += [median_stats(rows, i, s, target, n_folds) for i, s in enumerate(specs) if s.agg == "median"]
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    # saved with a number, which stands for the keys on the way to the statistics and back
    places = cut_lineage(partials.select("_anchor", *keys).distinct().withColumn("_id", F.monotonically_increasing_id()))
    wanted = places.select("_id", _at_anchors(anchors, specs, set(range(len(specs)))).alias("_k")).select("_id", "_k.*")
    # rows have no other keys than these, so what is missing is filled in here and not once more for each row
    gm = global_mean(rows, target)
    filled = F.transform(F.coalesce("values", F.array_repeat(F.lit(None).cast("double"), n_folds + 1)), lambda v: F.coalesce(v, F.col("_gm")))
    found = wanted.join(stats, ["spec", "key"], "left").withColumn("_gm", gm).withColumn("values", filled)
    back = found.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("spec", "values"))).alias("_m")).join(places, "_id")
    table = cut_lineage(back.select("_anchor", *keys, *[F.try_element_at("_m", F.lit(i)).alias(s.name) for i, s in enumerate(specs)]), "_anchor")
    found = [table.filter(F.col("_anchor") == i).select(*a.keys, *[specs[p].name for p in a.specs]) for i, a in enumerate(anchors)]
    # a part of the table counts as large as all of it: one that the categories bound is saved on its own, or rows would be
    # dealt out by its few keys
    return [(a, cut_lineage(t) if bounded(a) else t) for a, t in zip(anchors, found, strict=True)]


# Both frames can flow through the lookups as one stacked frame: ``_frame`` = 0 labelled, 1 unlabelled; the
# unlabelled rows carry fold = -1 and so match the all-folds statistics (held = -1) of every table.
FRAME = "_frame"
LABELLED, UNLABELLED = 0, 1


def stack_frames(train: DataFrame, test: DataFrame) -> DataFrame:
    te = test.withColumn(FRAME, F.lit(UNLABELLED))
    if FOLD in train.columns and FOLD not in test.columns:
        te = te.withColumn(FOLD, F.lit(ALL_FOLDS))
    return train.withColumn(FRAME, F.lit(LABELLED)).unionByName(te, allowMissingColumns=True)


def split_frames(rows: DataFrame, train_cols, test_cols) -> tuple[DataFrame, DataFrame]:
    """Inverse of ``stack_frames``: each side keeps its own columns plus every column added since."""
    added = [c for c in rows.columns if c not in set(train_cols) | set(test_cols) | {FRAME}]
    tr = rows.filter(F.col(FRAME) == LABELLED).select(*train_cols, *added)
    te = rows.filter(F.col(FRAME) == UNLABELLED).select(*test_cols, *added)
    return tr, te


def median_table(train: DataFrame, keys, target: str = TARGET, n_folds: int = N_FOLDS) -> DataFrame:
    """(K..., _held, median) for every held fold and for _held = -1 (all folds), in one quantile pass."""
    keys = list(keys)
    name = _name(keys, "median")
    held = F.explode(F.concat(F.filter(F.array(*[F.lit(i) for i in range(n_folds)]), lambda h: h != F.col(FOLD)),
                              F.array(F.lit(ALL_FOLDS))))
    hist = (train.filter(F.col(target).isNotNull())
            .groupBy(*keys, FOLD, target).agg(F.count(F.lit(1)).alias("_c"))
            .withColumn(HELD, held)
            .groupBy(*keys, HELD, target).agg(F.sum("_c").cast("long").alias("_w")))
    return exact_quantiles(None, keys + [HELD], target, {name: 0.5}, hist=hist)


def encode_rows(rows: DataFrame, specs=ENCODING_SPECS, target: str = TARGET, n_folds: int = N_FOLDS) -> DataFrame:
    """Adds every spec's column to a stacked frame: out-of-fold for labelled rows, all folds for the others, whose fold
    is -1 and whose target is null. One null-safe join for each anchor, after which a row keeps one value of each array; those
    that add most come last, so that rows are dealt out narrow. The tables' sizes are known (they are Parquet), so Spark
    broadcasts those under its threshold and sort-merge joins the others. Rows are never joined back by a
    row key, which may be null or repeated."""
    for s in specs:
        if s.agg not in AGGS:
            raise ValueError(f"unknown aggregate {s.agg!r}")
    narrow = rows.select(*dict.fromkeys(k for s in specs for k in s.keys), FOLD,
                         F.when(F.col(FRAME) == LABELLED, F.col(target)).alias(target))
    names = [s.name for s in specs]
    out = rows.select(*[c for c in rows.columns if c not in names])
    kept = out.columns
    at = F.col(FOLD) + 1
    tables = sorted(anchor_tables(narrow, specs, target, n_folds), key=lambda t: (bounded(t[0]), len(t[0].specs)))
    for i, (anchor, table) in enumerate(tables):
        own = [specs[p].name for p in anchor.specs]
        t = table.select(*[F.col(k).alias(f"_k{i}_{k}") for k in anchor.keys], *[F.col(n).alias(f"_v{i}_{n}") for n in own])
        out = out.join(t, [F.col(k).eqNullSafe(F.col(f"_k{i}_{k}")) for k in anchor.keys], "left").select(
            *out.columns, *[F.get(F.col(f"_v{i}_{n}"), at).alias(n) for n in own])
    return out.select(*kept, *names)


def target_encode(train: DataFrame, test: DataFrame, specs=ENCODING_SPECS, target: str = TARGET,
                  n_folds: int = N_FOLDS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Adds every spec's column: out-of-fold on ``train`` (needs the ``fold`` column), full-train on ``test``."""
    rows = encode_rows(stack_frames(train, test), specs, target, n_folds)
    tr, te = split_frames(rows, train.columns, test.columns)
    return tr, te, [s.name for s in specs]
