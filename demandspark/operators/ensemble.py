"""Ensemble-weight search from one pass of aggregated statistics.

With residuals e_i = p_i - y and weights summing to 1, the blend's residual sum of squares is wᵀGw where
G = Σ e eᵀ. One aggregate returns the six distinct entries of G and SStot; every candidate weight vector is
then scored from that single row without touching the data again:

* ``grid``: the simplex at step 1/20 (231 points) generated by ``explode`` of the statistics row.
* ``optimal_weights``: the exact minimiser of wᵀGw on the simplex — a convex quadratic in three variables,
  so the optimum lies on one of the 7 faces; each face's equality-constrained optimum has a closed form
  (G_S⁻¹1 / 1ᵀG_S⁻¹1) and the best feasible one is kept. This is the point an iterative bounded optimiser
  converges to, obtained exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import clip
from demandspark.sources.schemas import ROW_KEY

PREDS = ("p1", "p2", "p3")
# Grid resolution (step 0.05) and rounding of scores before the tie rule.
GRID_STEPS = 20
TIE_DIGITS = 12


def stack(long: DataFrame, learners, keys: DataFrame, key: str = ROW_KEY, value: str = "prediction") -> DataFrame:
    """``keys`` (one row for each ``key``, with whatever columns) with a column p1, p2, ... for each learner of ``long`` (key,
    learner, prediction).

    The plan itself asserts that the stack is complete: a key that lacks a learner or has one twice, a key that is in
    one of the two frames only, and a key twice in ``keys`` raise, when the result is written or read."""
    counts = [F.count_if(F.col("learner") == n).alias(f"_c{i}") for i, n in enumerate(learners)]
    wide = long.groupBy(F.col(key).alias("_key")).agg(
        *[F.max(F.when(F.col("learner") == n, F.col(value))).alias(f"p{i + 1}") for i, n in enumerate(learners)], *counts, F.count(F.lit(1)).alias("_all"))
    known = keys.withColumn("_known", F.lit(1))
    once = keys.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    wide = wide.join(once, "_key", "full_outer")
    j = known.join(wide, known[key].eqNullSafe(wide["_key"]), "full_outer")
    whole = (F.col("_known") == 1) & (F.col("_rows") == 1) & (F.col("_all") == len(learners))
    for i in range(len(learners)):
        whole = whole & (F.col(f"_c{i}") == 1)
    wrong = F.concat(F.lit(f"{key} "), F.coalesce(F.coalesce(F.col(key), F.col("_key")).cast("string"), F.lit("null")),
                     F.lit(" does not have one prediction of each learner"))
    checked = j.withColumn("_ok", F.when(F.coalesce(whole, F.lit(False)), F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean")))
    return checked.filter("_ok").select(*keys.columns, *[f"p{i + 1}" for i in range(len(learners))])


def gram_stats(df: DataFrame, y: str, preds=PREDS) -> DataFrame:
    """One row: n, sstot, g11, g12, g13, g22, g23, g33."""
    e = [F.col(p) - F.col(y) for p in preds]
    out = [F.count(F.col(y)).alias("n"), (F.var_pop(y) * F.count(F.col(y))).alias("sstot")]
    for i in range(3):
        for j in range(i, 3):
            out.append(F.sum(e[i] * e[j]).alias(f"g{i + 1}{j + 1}"))
    return df.agg(*out)


def _g(i: int, j: int) -> Column:
    a, b = min(i, j), max(i, j)
    return F.col(f"g{a}{b}")


def _quad(w1: Column, w2: Column, w3: Column) -> Column:
    w = [w1, w2, w3]
    total = None
    for i in range(3):
        for j in range(3):
            term = w[i] * w[j] * _g(i + 1, j + 1)
            total = term if total is None else total + term
    return total


def grid(stats: DataFrame, steps: int = GRID_STEPS) -> DataFrame:
    """(w1, w2, w3, r2) for every simplex point with weights i/steps (exact sums, exact ties)."""
    side = steps + 1
    pts = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1))).alias("_id"))
    pts = pts.select("*", (F.col("_id") / side).cast("int").alias("_i"), (F.col("_id") % side).cast("int").alias("_j"))
    pts = pts.filter(F.col("_i") + F.col("_j") <= steps)
    w1 = F.col("_i") / F.lit(float(steps))
    w2 = F.col("_j") / F.lit(float(steps))
    w3 = (F.lit(steps) - F.col("_i") - F.col("_j")) / F.lit(float(steps))
    pts = pts.select("*", w1.alias("w1"), w2.alias("w2"), w3.alias("w3"))
    return pts.select("w1", "w2", "w3", (F.lit(1.0) - F.try_divide(_quad(F.col("w1"), F.col("w2"), F.col("w3")), F.col("sstot")))
                      .alias("r2"))


def grid_best(grid_df: DataFrame) -> DataFrame:
    """Highest score; ties (scores rounded to 12 digits) go to the lexicographically largest weights."""
    return grid_df.orderBy(F.round("r2", TIE_DIGITS).desc(), F.col("w1").desc(), F.col("w2").desc(),
                           F.col("w3").desc()).limit(1)


def _face_candidates() -> Column:
    """Array of 7 structs (w1, w2, w3, obj) — each face's constrained optimum; obj null if infeasible."""
    cands = []
    zero = F.lit(0.0)
    for i in (1, 2, 3):
        w = [zero, zero, zero]
        w[i - 1] = F.lit(1.0)
        cands.append((w, _g(i, i)))
    for i, j in ((1, 2), (1, 3), (2, 3)):
        den = _g(i, i) + _g(j, j) - F.lit(2.0) * _g(i, j)
        wi = F.try_divide(_g(j, j) - _g(i, j), den)
        wj = F.try_divide(_g(i, i) - _g(i, j), den)
        w = [zero, zero, zero]
        w[i - 1], w[j - 1] = wi, wj
        cands.append((w, F.when((den > 0) & (wi >= 0) & (wj >= 0),
                                F.try_divide(_g(i, i) * _g(j, j) - _g(i, j) * _g(i, j), den))))
    # full support: adj(G)·1 / 1ᵀadj(G)1, objective det / 1ᵀadj(G)1
    c11 = _g(2, 2) * _g(3, 3) - _g(2, 3) * _g(2, 3)
    c12 = -(_g(1, 2) * _g(3, 3) - _g(1, 3) * _g(2, 3))
    c13 = _g(1, 2) * _g(2, 3) - _g(1, 3) * _g(2, 2)
    c22 = _g(1, 1) * _g(3, 3) - _g(1, 3) * _g(1, 3)
    c23 = -(_g(1, 1) * _g(2, 3) - _g(1, 2) * _g(1, 3))
    c33 = _g(1, 1) * _g(2, 2) - _g(1, 2) * _g(1, 2)
    r1, r2, r3 = c11 + c12 + c13, c12 + c22 + c23, c13 + c23 + c33
    s = r1 + r2 + r3
    det = _g(1, 1) * c11 + _g(1, 2) * c12 + _g(1, 3) * c13
    feasible = (det > 0) & (s > 0) & (r1 >= 0) & (r2 >= 0) & (r3 >= 0)
    cands.append(([F.try_divide(r, s) for r in (r1, r2, r3)], F.when(feasible, F.try_divide(det, s))))
    return F.array(*[F.struct(w[0].alias("w1"), w[1].alias("w2"), w[2].alias("w3"), obj.alias("obj"))
                     for w, obj in cands])


def optimal_weights(stats: DataFrame) -> DataFrame:
    """(w1, w2, w3, r2): exact simplex optimum of the blend R² (unclipped blend, as the search scores)."""
    c = stats.select("sstot", F.explode(_face_candidates()).alias("_c")).select("sstot", "_c.*")
    best = c.filter(F.col("obj").isNotNull()).orderBy(F.col("obj").asc(), F.col("w1").desc(), F.col("w2").desc()).limit(1)
    return best.select("w1", "w2", "w3", (F.lit(1.0) - F.try_divide("obj", "sstot")).alias("r2"))


def blend(df: DataFrame, weights: DataFrame, preds=PREDS, out: str = "blend", clipped: str | None = "blend_clipped",
          lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Weighted sum with the weights of a one-row frame (one scalar subquery, no join), optionally clipped."""
    df = df.withColumn("_w", weights.select(F.struct("w1", "w2", "w3")).scalar())
    b = F.col(preds[0]) * F.col("_w.w1") + F.col(preds[1]) * F.col("_w.w2") + F.col(preds[2]) * F.col("_w.w3")
    df = df.withColumn(out, b).drop("_w")
    return df.withColumn(clipped, clip(out, lo, hi)) if clipped else df
