"""Reading, staging and session helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import ensure_checkpoint_dir

JAVA_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, partition_by: str | None = None, release: bool = False,
          codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows re-reads the table, so a lost executor costs its running
    tasks only, and row ids given before stay as they are. ``release``: collect the driver's garbage
    after it, on which Spark's cleaner deletes the shuffle files of the finished job; otherwise
    they wait for the driver's next full collection. ``codec``: another compression than the session's.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    if release:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *columns: Column, keep=None) -> DataFrame:
    """The ``keep`` columns (default all) in one struct, ``_row``, beside columns of our own: names
    in ``docs`` then never meet ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("_row"), *columns)


def unpacked(df: DataFrame, *columns: Column, replace: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``_row`` again, less those that ``columns`` replace, then ``columns``."""
    taken = {c.lower() for c in replace}
    own = [F.col("_row").getField(f.name).alias(f.name) for f in df.schema["_row"].dataType if f.name.lower() not in taken]
    return df.select(*own, *columns)


def n_words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(JAVA_WORD)), F.lit(0)).cast("long")
