"""Positions in a global order, without one task for a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stage

#: Rows of one range partition, so of one sort.
RANGE_ROWS = 1_000_000


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` plus ``pos`` (0, 1, ... within each group by ``order``) and ``n`` (rows of the group).

    Rows are cut into ranges by group and order, so a group that holds most rows is many ranges;
    each range is numbered by itself and the counts of a group's earlier ranges are added. Rows equal
    in ``order`` lie in one range, in any order. Null groups are no groups of their own: pass a key
    without nulls. An empty table gives no rows. ``df`` is read twice (ranges are sampled), so
    it should be a staged table.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // range_rows))
    ranged = stage(df.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id()), name)
    here = Window.partitionBy("_range", *group)
    counts = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row a group and range that it lies in
    starts = counts.select(*group, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
                           F.sum("_rows").over(whole).alias("n"))
    return (ranged.withColumn("_at", F.row_number().over(here.orderBy(*order))).join(starts, [*group, "_range"])
            .select(*df.columns, (F.col("_start") + F.col("_at") - 1).cast("long").alias("pos"), F.col("n").cast("long").alias("n")))
