"""A plain form of the batch job, for comparison in the bench: one job for every statistic, windows in two steps,
one indexer fit a column, row counts as jobs, single-file output, nothing staged.

The same rows come out as from ``plans.etl.run`` with approximate medians; only the plan differs.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import calendar_columns
from shelfcast.operators.features import price_features
from shelfcast.operators.shaping import assemble_output, prepare_raw
from shelfcast.operators.split import drop_incomplete, split_by_date
from shelfcast.sources.panel import read_panel
from shelfcast.spec import PanelSpec


def run(spark: SparkSession, source: str, target: str, spec: PanelSpec) -> None:
    df = prepare_raw(read_panel(spark, source), spec)
    for c in spec.typed_numerics:
        found = df.approxQuantile(c, [0.5], 0.001)
        df = df.fillna({c: found[0] if found else 0.0})
    for c in spec.categoricals:
        top = df.where(F.col(f"`{c}`").isNotNull()).groupBy(f"`{c}`").count().orderBy(F.desc("count"), f"`{c}`").first()
        df = df.fillna({c: top[0] if top else "UNKNOWN"})
    df.count()
    by = Window.partitionBy(*[f"`{k}`" for k in spec.series_keys]).orderBy(f"`{spec.date}`")
    df = df.withColumns({**price_features(spec), **calendar_columns(F.col(f"`{spec.date}`"), spec.week_start)})
    for k in spec.lags:
        df = df.withColumn(f"demand_lag_{k}", F.lag(spec.target, k).over(by).cast("double"))
    for n in spec.windows:
        frame = by.rowsBetween(1 - n, 0)
        df = df.withColumn(f"demand_roll_mean_{n}", F.avg("demand_lag_1").over(frame)).withColumn(f"demand_roll_std_{n}", F.stddev_samp("demand_lag_1").over(frame))
    df = drop_incomplete(df, spec)
    df.count()
    parts = list(split_by_date(df, spec))
    for c in spec.categoricals:
        indexer = StringIndexer(inputCol=c, outputCol="_index", handleInvalid="keep").fit(parts[0])
        parts = [indexer.transform(p).drop(c).withColumnRenamed("_index", c) for p in parts]
    for name, part in zip(("train", "validation"), parts):
        assemble_output(part, spec).coalesce(1).write.mode("overwrite").option("header", False).csv(f"{target}/{name}")
