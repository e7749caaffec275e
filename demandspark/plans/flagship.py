"""The assembled feature plan (v2 flagship; v1 without lags) over the events-bound panel.

Shape of the plan: one aggregate of ``events`` into the panel (materialised once to the checkpoint folder,
so the labelled and unlabelled frames do not each re-scan the events), one projection of base features,
three frequency lookups, one statistics and one wide lag lookup, four encoding lookups (one per anchor), then
the domain projection and one rank join. The frames are checkpointed (reliable checkpoint folder) after the
base features, after the lags and after the encodings: each block's statistics are then computed from a
short plan, and a lost executor recomputes at most one block.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.category import CATEGORICAL_COLS
from demandspark.operators.domain import domain_features
from demandspark.operators.encoding import (ENCODING_SPECS, FOLD, FRAME, LABELLED, UNLABELLED, add_fold, encode_rows, stack_frames)
from demandspark.operators.features import IMPUTED_BY_MEDIAN, apply_frequency, base_features, derived_features, frequency_tables
from demandspark.operators.lags import REFERENCE_FALLBACK, lag_rows
from demandspark.session import cut_lineage
from demandspark.sources.panel import PanelBinding, load_binding, load_panel, split_panel
from demandspark.sources.schemas import ROW_KEY, TARGET

PANEL_COLUMNS = ["geohash", "day", "timestamp", TARGET, *CATEGORICAL_COLS, *IMPUTED_BY_MEDIAN, ROW_KEY]


@dataclass
class Frames:
    train: DataFrame
    test: DataFrame
    te_cols: list[str] = field(default_factory=list)
    binding: PanelBinding | None = None


def base_rows(spark: SparkSession, data_dir: str, binding: PanelBinding | None = None, cut_panel: bool = True) -> tuple[DataFrame, PanelBinding]:
    """Both frames with base features, stacked (labelled rows have their ``fold``), and the days they are bound to.

    The panel is materialised once (``cut_panel``), so that ``events`` is aggregated once."""
    binding = binding or load_binding(spark, data_dir)
    panel = load_panel(spark, data_dir)
    train, test = split_panel(cut_lineage(panel) if cut_panel else panel, binding)
    return base_features(stack_frames(add_fold(train), test), FRAME, (LABELLED, UNLABELLED)), binding


def base_frames(spark: SparkSession, data_dir: str, binding: PanelBinding | None = None,
                checkpoint: bool = True, cut_panel: bool | None = None) -> Frames:
    """Labelled frame with its ``fold``, unlabelled frame, both with base features; ``checkpoint`` materialises the two
    frames."""
    rows, binding = base_rows(spark, data_dir, binding, checkpoint if cut_panel is None else cut_panel)
    fr = split_rows(rows, binding)
    return _cut(fr) if checkpoint else fr


def split_rows(rows: DataFrame, binding: PanelBinding, te_cols=()) -> Frames:
    return Frames(rows.filter(F.col(FRAME) == LABELLED).drop(FRAME), rows.filter(F.col(FRAME) == UNLABELLED).drop(FRAME, FOLD, TARGET),
                  list(te_cols), binding)


def _cut(fr: Frames) -> Frames:
    return Frames(cut_lineage(fr.train), cut_lineage(fr.test), fr.te_cols, fr.binding)


def build_features(spark: SparkSession, data_dir: str, version: int = 2, binding: PanelBinding | None = None,
                   lag_fallback: Column | float | None = REFERENCE_FALLBACK, checkpoint: bool = True) -> Frames:
    """Both frames stacked through every lookup (unlabelled rows carry fold = -1 → all-folds statistics):
    one frequency, one lag and one encoding lookup chain for all rows, cut after the lags and after the
    encodings. Rows move and are saved with the panel's own (filled) columns and what was looked up; the features that
    follow from these are derived again where they are needed."""
    rows, binding = base_rows(spark, data_dir, binding, cut_panel=checkpoint)
    labelled = F.col(FRAME) == LABELLED
    derived = [c for c in rows.columns if c not in PANEL_COLUMNS and c not in (FOLD, FRAME)]

    def looked_up(found: DataFrame) -> DataFrame:
        return cut_lineage(found.drop(*derived)) if checkpoint else found.drop(*derived)

    if checkpoint:
        rows = derived_features(looked_up(rows))
    tables = frequency_tables(rows.filter(labelled))
    if version == 2:
        rows = lag_rows(rows, binding.ref_day, fallback=lag_fallback, labelled=labelled)
    rows = derived_features(looked_up(apply_frequency(rows, tables)))
    rows = derived_features(looked_up(encode_rows(rows, ENCODING_SPECS)))
    rows = domain_features(rows, version == 2, frame_col=FRAME)
    return split_rows(rows, binding, [s.name for s in ENCODING_SPECS])
