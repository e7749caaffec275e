"""Aggregate expressions for model quality and distribution shape, plus the hash fold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def r2(y, p) -> Column:
    """Coefficient of determination 1 - SSres/SStot as one aggregate (may be negative; not ``regr_r2``).

    Null where the target is constant (or there is one row), for which it is not defined."""
    y, p = _c(y), _c(p)
    ss_res = F.sum((y - p) * (y - p))
    ss_tot = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - F.try_divide(ss_res, ss_tot)


def skew_unbiased(col) -> Column:
    """Bias-corrected sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2); null below 3 values."""
    n = F.count(_c(col)).cast("double")
    g1 = F.skewness(_c(col))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_unbiased(col) -> Column:
    """Bias-corrected excess kurtosis G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6); null below 4 values."""
    n = F.count(_c(col)).cast("double")
    g2 = F.kurtosis(_c(col))
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


# Fold count and seed of the k-fold split shared by encodings and models.
N_FOLDS = 5
FOLD_SEED = 42


def hash_fold(key, n_folds: int = N_FOLDS, seed: int = FOLD_SEED) -> Column:
    """Deterministic fold of a row key: first 32 bits of md5('<seed>:<key>') modulo k.

    Stable under any partitioning and recomputation; the same split is used by encodings and models.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(n_folds)).cast("int")
