"""Model stage of the flagship: three learners × k folds on one saved matrix, stacking, exact ensemble weights, error
analysis and the validated submission; and the categorical learner of the first version.

A run is computed once for the state of the data folder's ``events`` (files, sizes and times) and its outputs are
written to the checkpoint folder; the report queries below are views of that run. Model fitting is not
SQL-expressible, so these queries are checked by row count and by pytest (SURVEY §2.11, **R**).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators import boosting as boo
from demandspark.operators import cv
from demandspark.operators import ensemble as ens
from demandspark.operators import errors as err
from demandspark.operators.encoding import FOLD
from demandspark.operators.matrix import categorical_features, feature_matrix, numeric_features
from demandspark.plans.flagship import build_features
from demandspark.session import cut_lineage, session_id
from demandspark.sources import sinks
from demandspark.sources.panel import sample_submission
from demandspark.sources.schemas import ROW_KEY, TARGET

LEARNERS = ("model_a", "model_b", "model_c")


@dataclass
class ModelRun:
    train: DataFrame          # feature-matrix rows of the labelled frame (with fold)
    oof: DataFrame            # Index, fold, learner, prediction
    test: DataFrame           # Index, learner, prediction (mean of fold models)
    rounds: DataFrame         # learner, fold, rounds kept, rounds grown
    stacked: DataFrame        # Index, demand, p1, p2, p3 (out-of-fold)
    test_stacked: DataFrame   # Index, p1, p2, p3
    weights: DataFrame        # w1, w2, w3, r2
    importance: DataFrame
    submission: DataFrame     # Index, demand
    sample: DataFrame         # Index, demand: the sample of the output


_RUNS: dict = {}


def data_state(spark: SparkSession, data_dir: str, table: str = "events") -> tuple:
    """What identifies the present files of a table: their number, sizes and times."""
    files = spark.read.parquet(f"{data_dir}/{table}.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum("file_size"), F.bit_xor(F.xxhash64("*"))).first())


def learners() -> list[cv.LearnerSpec]:
    """The three learners with their own rounds and patience: A with the categoricals, B and C on numeric columns."""
    num, cat = tuple(numeric_features(2)), tuple(categorical_features(2))
    configs = [boo.LEARNER_A, boo.LEARNER_B, boo.LEARNER_C]
    return [cv.LearnerSpec(n, c, num, cat if n == "model_a" else ()) for n, c in zip(LEARNERS, configs, strict=True)]


def run_models(spark: SparkSession, data_dir: str, parallelism: int = 5) -> ModelRun:
    key = (session_id(spark), data_dir, data_state(spark, data_dir))
    if key in _RUNS:
        return _RUNS[key]
    fr = build_features(spark, data_dir)
    train = cut_lineage(feature_matrix(fr.train.select("*"), with_target=True, extra=(ROW_KEY, FOLD)))
    test = cut_lineage(feature_matrix(fr.test, with_target=False))
    specs = learners()
    matrix = cv.assemble(train, test, specs)
    results = cv.fit_learners(matrix, specs, parallelism=parallelism)
    oof = _union([r.oof.withColumn("learner", F.lit(n)) for n, r in results.items()])
    tst = _union([cv.test_mean(r.test).withColumn("learner", F.lit(n)) for n, r in results.items()])
    oof, tst = cut_lineage(oof), cut_lineage(tst)
    rounds = spark.createDataFrame([(n, f, k, len(r.losses[f])) for n, r in results.items() for f, k in enumerate(r.rounds)],
                                   "learner string, fold int, rounds int, grown int")
    stacked = cut_lineage(ens.stack(oof, LEARNERS, train.select(ROW_KEY, TARGET)))
    test_stacked = cut_lineage(ens.stack(tst, LEARNERS, test.select(ROW_KEY)))
    weights = cut_lineage(ens.optimal_weights(ens.gram_stats(stacked, TARGET)))
    blended = ens.blend(test_stacked, weights, out="blend", clipped="blend_clipped")
    submission = sinks.submission_frame(blended, "blend_clipped")
    run = ModelRun(train, oof, tst, rounds, stacked, test_stacked, weights, cut_lineage(cv.importances(results["model_b"])), submission,
                   sample_submission(test))
    _RUNS[key] = run
    return run


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def v1_learner() -> tuple[boo.BoostingConfig, list[str]]:
    """Settings and categoricals of the first version's categorical learner: eight categoricals, the cell among
    them, whose levels are unbounded and therefore ordered by target instead of indexed."""
    return boo.LEARNER_A_V1, categorical_features(1)


def fit_v1(spark: SparkSession, data_dir: str, parallelism: int = 5) -> cv.FoldResult:
    fr = build_features(spark, data_dir, version=1)
    config, cats = v1_learner()
    train = feature_matrix(fr.train, version=1, with_target=True, extra=(ROW_KEY, FOLD))
    test = feature_matrix(fr.test, version=1, with_target=False)
    train, test, ordered = cv.order_categories(cut_lineage(train), cut_lineage(test), cats)
    spec = cv.LearnerSpec("model_v1", config, (*numeric_features(1), *ordered))
    return cv.fit_folds(cv.assemble(train, test, [spec]), spec, parallelism=parallelism)


# ---- report queries ---------------------------------------------------------------------------------------

def cv_oof_predictions(spark, d):
    return run_models(spark, d).oof


def cv_test_predictions(spark, d):
    return run_models(spark, d).test


def cv_scores(spark, d):
    r = run_models(spark, d)
    return _union([cv.fold_scores(r.oof.filter(F.col("learner") == n), r.train).select(F.lit(n).alias("learner"), FOLD, "r2") for n in LEARNERS])


def cv_fold_summary(spark, d):
    r = run_models(spark, d)
    return _union([cv.score_summary(r.oof.filter(F.col("learner") == n), r.train).select(F.lit(n).alias("learner"), "*") for n in LEARNERS])


def model_importance(spark, d):
    return run_models(spark, d).importance


def cv_rounds(spark, d):
    """Rounds that each fold's model keeps, and rounds that were grown to find them."""
    return run_models(spark, d).rounds


def cv_v1_oof_predictions(spark, d):
    return fit_v1(spark, d).oof


def ens_stack_models(spark, d):
    return run_models(spark, d).stacked


def ens_model_grid_best(spark, d):
    return ens.grid_best(ens.grid(ens.gram_stats(run_models(spark, d).stacked, TARGET)))


def ens_model_weights(spark, d):
    return run_models(spark, d).weights


def model_summary(spark, d):
    """Per learner: OOF R², fold mean / std; plus the ensemble's OOF R² (unclipped blend) and weights."""
    r = run_models(spark, d)
    per = cv_fold_summary(spark, d).select("learner", "oof_r2", "fold_mean", "fold_std", F.lit(None).cast("double").alias("weight"))
    w = r.weights
    ens_row = w.select(F.lit("ensemble").alias("learner"), F.col("r2").alias("oof_r2"),
                       F.lit(None).cast("double").alias("fold_mean"), F.lit(None).cast("double").alias("fold_std"),
                       F.lit(None).cast("double").alias("weight"))
    weights = w.select(F.explode(F.array(*[F.struct(F.lit(f"weight_{n}").alias("learner"), F.col(f"w{i + 1}").alias("weight"))
                                           for i, n in enumerate(LEARNERS)])).alias("_w")).select(
        "_w.learner", F.lit(None).cast("double").alias("oof_r2"), F.lit(None).cast("double").alias("fold_mean"),
        F.lit(None).cast("double").alias("fold_std"), "_w.weight")
    return per.unionByName(ens_row).unionByName(weights)


def model_errors(spark, d) -> DataFrame:
    """Error columns of the clipped ensemble blend on the labelled rows."""
    r = run_models(spark, d)
    blended = ens.blend(r.stacked, r.weights, out="blend", clipped=None)
    feats = r.train.select(ROW_KEY, "hour")
    return err.residuals(blended.join(feats, ROW_KEY), "blend")


def submission(spark, d):
    """The submission, checked against the sample within its plan."""
    r = run_models(spark, d)
    return sinks.checked_submission(r.submission, r.sample)


def submission_head(spark, d):
    return sinks.head(run_models(spark, d).submission)


def submission_contract(spark, d):
    r = run_models(spark, d)
    return sinks.contract_stats(r.submission, r.sample)


def submission_summary(spark, d):
    return sinks.summary(run_models(spark, d).submission)


MODEL_QUERIES = {
    "cv_oof_predictions": cv_oof_predictions,
    "cv_test_predictions": cv_test_predictions,
    "cv_scores": cv_scores,
    "cv_fold_summary": cv_fold_summary,
    "cv_rounds": cv_rounds,
    "cv_v1_oof_predictions": cv_v1_oof_predictions,
    "model_importance": model_importance,
    "model_summary": model_summary,
    "ens_stack_models": ens_stack_models,
    "ens_model_grid_best": ens_model_grid_best,
    "ens_model_weights": ens_model_weights,
    "err_model_mae_by_hour": lambda s, d: err.mae_by(model_errors(s, d), "hour"),
    "submission": submission,
    "submission_contract": submission_contract,
    "submission_summary": submission_summary,
    "submission_head": submission_head,
}
