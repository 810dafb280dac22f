"""Completeness filter and the date split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.spec import RETAIL, PanelSpec


def required_present(df: DataFrame, spec: PanelSpec = RETAIL) -> list[str]:
    present = set(df.columns)
    return [c for c in spec.required if c in present]


def drop_incomplete(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """Drop rows with null or NaN in any required column that exists (lag warm-up rows,
    unparsable dates via the calendar columns, NaN text)."""
    return df.dropna(how="any", subset=required_present(df, spec))


def _cutoff(cutoff: str) -> Column:
    return F.to_date(F.lit(cutoff))


def split_train(df: DataFrame, spec: PanelSpec = RETAIL, cutoff: str | None = None) -> DataFrame:
    return df.where(F.col(f"`{spec.date}`") < _cutoff(cutoff or spec.cutoff))


def split_validation(df: DataFrame, spec: PanelSpec = RETAIL, cutoff: str | None = None) -> DataFrame:
    """Rows on or after the cutoff (the boundary day belongs to validation)."""
    return df.where(F.col(f"`{spec.date}`") >= _cutoff(cutoff or spec.cutoff))


def split_by_date(df: DataFrame, spec: PanelSpec = RETAIL, cutoff: str | None = None) -> tuple[DataFrame, DataFrame]:
    return split_train(df, spec, cutoff), split_validation(df, spec, cutoff)


def sort_by_date(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """Global order by date (range-partitioned sort); only for ordered exports."""
    return df.orderBy(F.asc_nulls_first(spec.date))
