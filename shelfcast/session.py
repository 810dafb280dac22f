"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources import files

_JOB: ContextVar[str | None] = ContextVar("shelfcast_job", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfcast") -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; if it
    is missing there, this raises instead of falling back to a machine-local folder.
    Only an unconfigured local-mode session (tests, laptop) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared, reliable folder")
    path = tempfile.mkdtemp(prefix="shelfcast-ckpt-", dir=os.environ.get("SHELFCAST_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A folder below the checkpoint folder for all that a job stages; deleted when the job ends, well or not.

    Frames that read staged tables must be used up inside. A job inside another one shares its folder.
    """
    if _JOB.get():
        yield _JOB.get()
        return
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    token = _JOB.set(path)
    try:
        yield path
    finally:
        _JOB.reset(token)
        files.remove(spark, path)


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet, in the job's folder or else the checkpoint folder, and read it back: the lineage is
    cut, and later passes read the columns and partitions that they need."""
    spark = df.sparkSession
    path = f"{(_JOB.get() or ensure_checkpoint_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the session's checkpoint folder and cut its lineage (in a job, a table of the job)."""
    if _JOB.get():
        return staged(df, "checkpoint")
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
