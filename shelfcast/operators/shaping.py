"""Schema shaping: drop leaky columns, type the text columns, order the model matrix."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.parsing import to_date, to_double
from shelfcast.spec import RETAIL, PanelSpec

log = logging.getLogger(__name__)


def drop_leaky(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """Remove target-leaking columns; names that are absent are ignored."""
    return df.drop(*spec.leaky)


def cast_numeric(df: DataFrame, spec: PanelSpec = RETAIL, cols: tuple[str, ...] | None = None) -> DataFrame:
    """Text -> double for the raw numerics and the target; malformed text -> null."""
    cols = tuple(spec.typed_numerics if cols is None else cols)
    return df.withColumns({c: to_double(F.col(c)) for c in cols})


def parse_date(df: DataFrame, spec: PanelSpec = RETAIL, col: str | None = None, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text -> date with ``fmt``; malformed text -> null."""
    col = spec.date if col is None else col
    return df.withColumn(col, to_date(F.col(col), fmt))


def prepare_raw(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """The three shaping steps in pipeline order: drop leaky, cast numerics, parse the date."""
    return parse_date(cast_numeric(drop_leaky(df, spec), spec), spec)


def output_columns(df: DataFrame, spec: PanelSpec = RETAIL) -> list[str]:
    present = set(df.columns)
    wanted = list(spec.output_cols)
    missing = [c for c in wanted if c not in present]
    if missing:
        log.warning("columns not found in DataFrame, skipped: %s", missing)
    return [c for c in wanted if c in present]


def assemble_output(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """Model-matrix projection: target, categoricals, raw numerics, engineered (date dropped)."""
    return df.select(*[F.col(f"`{c}`") for c in output_columns(df, spec)])
