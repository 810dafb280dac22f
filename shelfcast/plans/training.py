"""The whole feature pipeline: raw text panel -> encoded train / validation matrices.

Jobs at scale: one aggregate for the medians; one for the modes, which also yields the
rows per series used to find hot series; one for the label table; then the two matrix
writes. The typed input and the post-filter panel can be staged as Parquet in the shared folder:
the input text is then parsed once, the fits read their columns alone, and the panel is partitioned by
split, so that the label fit reads the categoricals of the training part and each matrix its own part.
Row counts ride along as observations (no extra jobs).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.encode import LabelModel, apply_labels, drop_unseen, fit_labels
from shelfcast.operators.features import engineer_features
from shelfcast.operators.impute import ImputerStats, apply_imputer, fit_imputer
from shelfcast.operators.metrics import RowMetrics
from shelfcast.operators.shaping import assemble_output, output_columns, prepare_raw
from shelfcast.operators.split import drop_incomplete, sort_by_date, split_train, split_validation
from shelfcast.spec import RETAIL, PanelSpec
from shelfcast.session import staged

#: Partition column of the staged panel.
SPLIT_COL = "_split"


@dataclass
class MatrixResult:
    train: DataFrame
    validation: DataFrame
    imputer: ImputerStats
    labels: LabelModel
    metrics: RowMetrics = field(default_factory=RowMetrics)


def featured_panel(raw: DataFrame, spec: PanelSpec = RETAIL, median_method: str = "exact",
                   fit_on: str = "all", imputer: ImputerStats | None = None,
                   metrics: RowMetrics | None = None, stage: bool = False) -> tuple[DataFrame, ImputerStats]:
    """Shape, impute and engineer features (before the completeness filter). ``stage``: the typed rows are written
    and read back, for the passes of the fit and the features."""
    typed = prepare_raw(raw, spec)
    if stage:
        typed = staged(typed, "typed")
    totals = None
    if imputer is None:
        if fit_on == "all":
            basis = typed
        elif fit_on == "train":
            basis = split_train(typed, spec)
        else:
            raise ValueError(f"fit_on must be 'all' or 'train', got {fit_on!r}")
        imputer = fit_imputer(basis, spec, median_method)
        # series totals count every row only when the fit saw every row
        totals = imputer.series_totals if fit_on == "all" else None
    imputed = apply_imputer(typed, imputer)
    if metrics is not None:
        imputed = metrics.observe(imputed, "imputed")
    return engineer_features(imputed, spec, totals), imputer


def build_training_matrix(
    raw: DataFrame,
    spec: PanelSpec = RETAIL,
    median_method: str = "exact",
    fit_on: str = "all",
    unseen: str = "index",
    materialize: str = "none",
    metrics: RowMetrics | None = None,
    order: str = "none",
) -> MatrixResult:
    """Raw text panel -> (train, validation) model matrices in output column order.

    ``materialize``: ``"checkpoint"`` stages the typed input and the complete panel, by split, below the session's
    checkpoint folder (reliable, survives executor loss; inside ``job_folder`` deleted with the job);
    ``"none"`` keeps one lazy plan.
    ``order``: ``"none"``; ``"partition"`` sorts rows by date inside each output partition
    (no shuffle); ``"global"`` sorts each split by date (a range-partitioned shuffle).
    """
    metrics = metrics or RowMetrics()
    if materialize not in ("checkpoint", "none"):
        raise ValueError(f"materialize must be 'checkpoint' or 'none', got {materialize!r}")
    stage = materialize == "checkpoint"
    raw = metrics.observe(raw, "raw")
    featured, imputer = featured_panel(raw, spec, median_method, fit_on, metrics=metrics, stage=stage)
    featured = metrics.observe(featured, "before_drop")
    complete = metrics.observe(drop_incomplete(featured, spec), "after_drop")
    if stage:
        day, cutoff = F.col(f"`{spec.date}`"), F.to_date(F.lit(spec.cutoff))
        part = F.when(day >= cutoff, "validation").when(day < cutoff, "train").otherwise("none")
        complete = staged(complete.withColumn(SPLIT_COL, part), "panel", partition_by=SPLIT_COL)
        train_raw, val_raw = (complete.where(F.col(SPLIT_COL) == name).drop(SPLIT_COL) for name in ("train", "validation"))
    else:
        train_raw, val_raw = split_train(complete, spec), split_validation(complete, spec)
    train_raw = metrics.observe(train_raw, "train_before_encoding")
    val_raw = metrics.observe(val_raw, "validation_before_encoding")
    labels = fit_labels(train_raw, spec)
    train = apply_labels(train_raw, labels, "index")
    val = apply_labels(val_raw, labels, unseen)
    if unseen == "index":
        val = drop_unseen(val, spec)
    train, val = _ordered(train, spec, order), _ordered(val, spec, order)
    train = metrics.observe(assemble_output(train, spec), "train")
    val = metrics.observe(assemble_output(val, spec), "validation")
    return MatrixResult(train, val, imputer, labels, metrics)


def _ordered(df: DataFrame, spec: PanelSpec, order: str) -> DataFrame:
    if order == "none":
        return df
    if order == "partition":
        return df.sortWithinPartitions(F.asc_nulls_first(spec.date))
    if order == "global":
        return sort_by_date(df, spec)
    raise ValueError(f"order must be 'none', 'partition' or 'global', got {order!r}")


def apply_training_matrix(
    raw: DataFrame,
    imputer: ImputerStats,
    labels: LabelModel,
    spec: PanelSpec = RETAIL,
    unseen: str = "index",
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Matrices from an already fitted imputer and label table (no fitting): the same
    transforms as ``build_training_matrix`` with frozen statistics. ``keep`` carries extra
    columns (e.g. a partition column) through to the output."""
    return matrices_from_imputed(apply_imputer(prepare_raw(raw, spec), imputer), labels, spec, unseen, keep)


def matrices_from_imputed(imputed: DataFrame, labels: LabelModel, spec: PanelSpec = RETAIL, unseen: str = "index",
                          keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of imputed rows with fitted labels; ``keep`` columns stand last among the
    input's, so that they order rows only where all else is equal."""
    complete = drop_incomplete(engineer_features(imputed, spec), spec)
    train = apply_labels(split_train(complete, spec), labels, "index")
    val = apply_labels(split_validation(complete, spec), labels, unseen)
    if unseen == "index":
        val = drop_unseen(val, spec)

    def out(df):
        return df.select(*[F.col(f"`{c}`") for c in output_columns(df, spec) + list(keep)])

    return out(train), out(val)
