"""Row counts at the pipeline's checkpoints without extra jobs.

``observe`` attaches named counters to a plan; they are filled by whatever action runs
the plan anyway (the writes), so counting costs no extra scan.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.spec import RETAIL, PanelSpec


class RowMetrics:
    def __init__(self) -> None:
        self._obs: dict[str, tuple[Observation, int]] = {}

    def observe(self, df: DataFrame, name: str) -> DataFrame:
        obs = Observation(name)
        self._obs[name] = (obs, len(df.columns))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def get(self, timeout: float = 0.5) -> dict[str, dict[str, int]]:
        """Counters of every observation, null for those whose plan no action has run, or whose part of it Spark has
        left out (beside an empty table, say): such observations end without a row.

        Spark reports an observation shortly after its action; ``timeout`` (seconds, for all together) bounds
        the wait for that, so a plan that never runs does not block.
        """
        end = time.monotonic() + timeout
        out = {}
        for name, (obs, ncols) in self._obs.items():
            while not (done := obs._jo.future().isCompleted()) and time.monotonic() < end:
                time.sleep(0.02)
            counted = done and obs._jo.getRow().length() > 0
            out[name] = {"rows": obs.get["rows"] if counted else None, "columns": ncols}
        return out


def _all_present(df: DataFrame, cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        col = F.col(f"`{c}`")
        dtype = dict(df.dtypes)[c]
        ok = col.isNotNull()
        if dtype in ("double", "float"):
            ok = ok & ~F.isnan(col)
        cond = cond & ok
    return cond


def row_metrics_frame(featured: DataFrame, spec: PanelSpec = RETAIL, cutoff: str | None = None) -> DataFrame:
    """One row of counts from one pass over the featured (imputed) panel:
    rows before the completeness filter, after it, and in each split."""
    from shelfcast.operators.split import required_present

    complete = _all_present(featured, required_present(featured, spec))
    d = F.col(f"`{spec.date}`")
    cut = F.to_date(F.lit(cutoff or spec.cutoff))

    def cnt(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    return featured.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_before_drop"),
        cnt(complete).alias("rows_after_drop"),
        cnt(complete & (d < cut)).alias("train_rows"),
        cnt(complete & (d >= cut)).alias("validation_rows"),
    )
