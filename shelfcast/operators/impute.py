"""Missing-value imputation as a fit/apply pair.

``fit_imputer`` runs two distributed aggregates (medians; modes plus per-series row
totals) and returns a few scalars (and the small totals table); ``apply_imputer`` turns
the scalars into literals inside one projection, so the apply step is a narrow,
codegen'd map with no join and no shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import stats
from shelfcast.spec import MEDIAN_RELATIVE_ERROR, RETAIL, PanelSpec
from shelfcast.session import reliable_checkpoint


@dataclass
class ImputerStats:
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    # rows per series after key filling (small DataFrame; not persisted with the stats)
    series_totals: DataFrame | None = None

    def to_json(self) -> str:
        return json.dumps({"medians": self.medians, "modes": self.modes}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "ImputerStats":
        d = json.loads(text)
        return cls(medians=d["medians"], modes=d["modes"])


def fit_numeric(df: DataFrame, spec: PanelSpec = RETAIL, method: str = "exact",
                relative_error: float = MEDIAN_RELATIVE_ERROR) -> dict[str, float]:
    cols = [c for c in spec.typed_numerics if c in df.columns]
    return stats.medians(df, cols, method, relative_error)


def fit_categorical(df: DataFrame, spec: PanelSpec = RETAIL) -> dict[str, str]:
    cols = [c for c in spec.categoricals if c in df.columns]
    return stats.modes(df, cols)


def fit_categorical_with_series(df: DataFrame, spec: PanelSpec = RETAIL) -> tuple[dict[str, str], DataFrame | None]:
    """Modes plus per-series row totals (after key filling) from one aggregation.

    The value counts are checkpointed (reliable, small: distinct categories + series),
    then modes (a few rows) are collected and the series totals stay a DataFrame.
    """
    cols = [c for c in spec.categoricals if c in df.columns]
    keys = [k for k in spec.series_keys if k in df.columns]
    if not spec.hot_series_rows or len(keys) != len(spec.series_keys):
        return stats.modes(df, cols), None
    counts = reliable_checkpoint(stats.category_counts(df, cols, keys))
    modes = stats.collect_modes(stats.modes_from_counts(counts), cols)
    totals = stats.series_totals(counts, df.schema, keys, {k: v for k, v in modes.items() if k in keys})
    return modes, totals


def fit_imputer(df: DataFrame, spec: PanelSpec = RETAIL, method: str = "exact",
                relative_error: float = MEDIAN_RELATIVE_ERROR) -> ImputerStats:
    modes, totals = fit_categorical_with_series(df, spec)
    return ImputerStats(fit_numeric(df, spec, method, relative_error), modes, totals)


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Replace nulls (not NaN) with the given per-column constants."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.items() if c in df.columns})


def fill_numeric(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return fill_values(df, medians)


def fill_categorical(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return fill_values(df, modes)


def apply_imputer(df: DataFrame, fitted: ImputerStats) -> DataFrame:
    return fill_categorical(fill_numeric(df, fitted.medians), fitted.modes)


def impute_missing(df: DataFrame, spec: PanelSpec = RETAIL, method: str = "exact",
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Fill numerics (target included) with medians and categoricals with modes.

    Statistics come from ``fit_on`` (default: ``df`` itself, all rows before any split).
    """
    return apply_imputer(df, fit_imputer(df if fit_on is None else fit_on, spec, method))
