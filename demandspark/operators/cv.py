"""Out-of-fold fitting of boosted learners over one saved matrix.

For each fold f a model is grown on the rows with ``fold != f``, cut by the loss on the held rows, and predicts the
held rows (their out-of-fold prediction) and the unlabelled frame, whose prediction is the mean over the fold models.
As in the reference the held fold chooses the rounds and is then scored, which is slightly optimistic.

All learners share one assembled matrix, written to the shared folder: a fit scans it with the fold as a pushed
filter, and nothing is cached by this module. Each fit is a distributed MLlib job; the driver only loops over the folds
(as ``CrossValidator`` does) and, with ``parallelism`` > 1, has several folds' jobs under way at once. A fit has as many
tasks as its rows are worth: each one sends statistics of all nodes and bins, however few rows it has. On a matrix that one task can
hold, a fit is one task, and all learners' folds are under way at once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.metrics import N_FOLDS, r2
from demandspark.operators.boosting import FEATURES, PREDICTION, BoostingConfig, alone, boost, gain_importances, node_table, rounds_needed, with_first
from demandspark.operators.encoding import FOLD, FRAME, LABELLED, UNLABELLED
from demandspark.session import cut_lineage
from demandspark.sources.schemas import ROW_KEY, TARGET

#: Feature values that a task of a fit looks at, at least: about ten times the statistics that it sends for the widest level of a tree
#: (64 nodes x 256 bins x 100 columns).
TASK_VALUES = 1 << 24


@dataclass(frozen=True)
class LearnerSpec:
    """A learner: its settings, the numeric columns it sees, and the categorical ones (indexed, few levels)."""

    name: str
    config: BoostingConfig
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass
class Matrix:
    """One row for each row of both frames: row key, fold (-1: unlabelled), target, and a vector of ``columns``."""

    rows: DataFrame
    columns: list[str]
    tasks: int = 0          # tasks of a fit at most; 0: as many as the rows have partitions
    alone: bool = False     # whether a fit is one task

    def of(self, spec: LearnerSpec) -> DataFrame:
        """The learner's part of the vector, cut out while scanning."""
        if spec.columns == self.columns:
            return self.rows
        cut = VectorSlicer(inputCol=FEATURES, outputCol="_own", indices=[self.columns.index(c) for c in spec.columns])
        return cut.transform(self.rows).drop(FEATURES).withColumnRenamed("_own", FEATURES)


def assemble(train: DataFrame, test: DataFrame, specs: list[LearnerSpec]) -> Matrix:
    """The matrix of all columns that the learners see, saved once. Categoricals are indexed on the labelled frame;
    levels it does not have share one further index."""
    numeric = list(dict.fromkeys(c for s in specs for c in s.numeric))
    categorical = list(dict.fromkeys(c for s in specs for c in s.categorical))
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"{c}__idx" for c in categorical]], outputCol=FEATURES, handleInvalid="keep"))
    model = Pipeline(stages=stages).fit(train)
    tr = model.transform(train).select(ROW_KEY, FOLD, TARGET, FEATURES)
    te = model.transform(test).select(ROW_KEY, F.lit(-1).alias(FOLD), F.lit(None).cast("double").alias(TARGET), FEATURES)
    # partitions by the size of the rows: a fit has several jobs for each level of each tree
    rows, columns = cut_lineage(tr.unionByName(te).hint("rebalance")), [*numeric, *categorical]
    n = rows.count()
    return Matrix(rows, columns, fit_tasks(n, len(columns)), alone(n, len(columns)))


def fit_tasks(rows: int, columns: int) -> int:
    """Tasks of a fit on a matrix of this size: they grow with it. Below one task's worth 0, the partitions stay as they are."""
    return rows * columns // TASK_VALUES


@dataclass
class FoldResult:
    oof: DataFrame          # Index, fold, prediction
    test: DataFrame         # Index, fold, prediction (one row per fold model)
    models: list
    columns: list[str]
    rounds: list[int]       # rounds kept by each fold's model
    losses: list[list[float]] = field(default_factory=list)


def fit_folds(matrix: Matrix, spec: LearnerSpec, n_folds: int = N_FOLDS, parallelism: int = 1) -> FoldResult:
    return fit_learners(matrix, [spec], n_folds, parallelism)[spec.name]


def fit_learners(matrix: Matrix, specs: list[LearnerSpec], n_folds: int = N_FOLDS, parallelism: int = 1) -> dict[str, FoldResult]:
    """The fold models of all learners, ``parallelism`` of them under way at once. The first fold of each learner finds by
    doubling how many rounds it takes; as soon as it has, the learner's other folds begin with about as many, and go on doubling
    where that is too few. A fit that is one task ends where its patience does, so there the folds need not wait for the first,
    unless the learner's settings say how many rounds to begin with, and all of them are under way."""
    rows = {s.name: matrix.of(s) for s in specs}

    def one(spec: LearnerSpec, f: int, config: BoostingConfig):
        labelled, unlabelled = rows[spec.name].filter(F.col(FOLD) >= 0), rows[spec.name].filter(F.col(FOLD) < 0)
        held, others = labelled.filter(F.col(FOLD) == f), labelled.filter(F.col(FOLD) != f)
        model, losses = boost(config, others.coalesce(matrix.tasks) if matrix.tasks else others, held, f)
        oof = model.transform(held).select(ROW_KEY, FOLD, PREDICTION)
        tp = model.transform(unlabelled).select(ROW_KEY, F.lit(f).alias(FOLD), PREDICTION)
        return model, losses, oof, tp

    with ThreadPoolExecutor(len(specs) * n_folds if matrix.alone else max(parallelism, 1)) as pool:
        first, results = {pool.submit(one, s, 0, s.config): s for s in specs}, {}
        for done, spec in first.items():
            at_once = range(1, n_folds if matrix.alone and spec.config.first is None else 1)
            results[spec.name] = [done, *[pool.submit(one, spec, f, spec.config) for f in at_once]]
        for done in as_completed(first):
            spec, found = first[done], done.result()
            begin = with_first(spec.config, rounds_needed(spec.config, found[1]))
            results[spec.name] += [pool.submit(one, spec, f, begin) for f in range(len(results[spec.name]), n_folds)]
        results = {name: [j.result() for j in jobs] for name, jobs in results.items()}
    return {s.name: _fold_result(s, results[s.name]) for s in specs}


def _fold_result(spec: LearnerSpec, results: list) -> FoldResult:
    oof, tp = results[0][2:]
    for _, _, o, t in results[1:]:
        oof, tp = oof.unionByName(o), tp.unionByName(t)
    models = [r[0] for r in results]
    return FoldResult(oof, tp, models, spec.columns, [m.getNumTrees for m in models], [r[1] for r in results])


def test_mean(test_preds: DataFrame) -> DataFrame:
    """Unlabelled prediction = mean of the fold models' predictions."""
    return test_preds.groupBy(ROW_KEY).agg(F.avg(PREDICTION).alias(PREDICTION))


def fold_scores(oof: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, r2) per held fold."""
    j = oof.join(labels.select(ROW_KEY, TARGET), ROW_KEY)
    return j.groupBy(FOLD).agg(r2(TARGET, PREDICTION).alias("r2"))


def score_summary(oof: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: out-of-fold R² over all rows, mean and population std of the per-fold R²."""
    j = oof.join(labels.select(ROW_KEY, TARGET), ROW_KEY)
    overall = j.agg(r2(TARGET, PREDICTION).alias("oof_r2"))
    per_fold = fold_scores(oof, labels).agg(F.struct(F.avg("r2").alias("m"), F.stddev_pop("r2").alias("s"))).scalar()
    return overall.withColumn("_f", per_fold).select("oof_r2", F.col("_f.m").alias("fold_mean"), F.col("_f.s").alias("fold_std"))


def importances(result: FoldResult, top: int = 25) -> DataFrame:
    """Top features by gain of the last fold's model, unnormalised."""
    return gain_importances(node_table(result.models[-1]), result.columns, top)


def order_categories(train: DataFrame, test: DataFrame, columns, n_folds: int = N_FOLDS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Categoricals of any number of levels as numbers for threshold splits: the smoothed mean target of the level
    over the other folds (labelled rows) or all folds (unlabelled rows). Along this order the best split of the
    levels in two is a threshold, so no bins are spent on single levels; a level that was not seen gets the global
    mean. But for that mean, labelled rows never see their own fold."""
    from demandspark.operators.encoding import EncodingSpec, encode_rows, stack_frames

    specs = [EncodingSpec((c,), "smooth") for c in columns]
    rows = encode_rows(stack_frames(train, test), specs, TARGET, n_folds)
    names = [s.name for s in specs]
    return (rows.filter(F.col(FRAME) == LABELLED).select(*train.columns, *names),
            rows.filter(F.col(FRAME) == UNLABELLED).select(*test.columns, *names), names)
