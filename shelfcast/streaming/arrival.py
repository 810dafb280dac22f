"""File-arrival job: new raw panel files under a folder update the model matrices.

A file-source stream watches the input folder. Each micro-batch holds the rows of the
newly arrived files, which are read by header name as in a batch run; ``foreachBatch`` first appends them to a history table (one folder
per batch id, overwritten on retry, so a replayed batch is idempotent). Row-frame
windows are not supported on streaming frames, which is why the feature work runs in
batch inside ``foreachBatch``. Two modes:

* ``full`` -- refit and rebuild both matrices over the whole history: the same result
  as one batch run over every file that has arrived.
* ``incremental`` -- statistics (medians, modes, labels) are fitted once, on the first
  history that has complete training rows, and frozen (published next to the output, reused after
  a restart; ``adopt_fit`` starts from one that was made elsewhere). Until then batches are kept as
  history and nothing is written. Afterwards a batch costs what it brings: rows that follow those of
  their series read the series' last rows and are appended; rows that arrive late have the months
  around them computed anew (see ``series_store``). Refit by starting over with a new output folder.

The stream's progress is kept in ``checkpoint`` (a shared, reliable folder), so a
restarted job resumes at the first unprocessed file.
"""

from __future__ import annotations

import logging
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.encode import LabelModel
from shelfcast.operators.impute import ImputerStats
from shelfcast.plans.model import train_job
from shelfcast.plans.training import build_training_matrix
from shelfcast.session import job_folder
from shelfcast.sources import files
from shelfcast.sources.panel import RAW_SCHEMA, read_panel, write_matrices
from shelfcast.spec import RETAIL, PanelSpec
from shelfcast.streaming.series_store import BUCKET_COL, SeriesStore

log = logging.getLogger("shelfcast.stream")

__all__ = ["BUCKET_COL", "adopt_fit", "load_frozen_fit", "on_arrival", "published_fit"]

def history_path(output: str) -> str:
    return f"{output.rstrip('/')}/_history"


def fit_path(output: str) -> str:
    return f"{output.rstrip('/')}/_fit"


def _append_history(batch: DataFrame, output: str, batch_id: int) -> None:
    # idempotent append: a retried batch overwrites its own folder
    batch.write.mode("overwrite").parquet(f"{history_path(output)}/batch_id={batch_id}")


def _read_history(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(history_path(output)).drop("batch_id")


def _history_of(spark: SparkSession, output: str, batch_id: int) -> DataFrame:
    """The rows of one batch, from its own folder: a text file is parsed once."""
    return spark.read.schema(RAW_SCHEMA).parquet(f"{history_path(output)}/batch_id={batch_id}")


def _full_batch(spark, output, spec, median_method, fmt, model_output, model_params):
    def process(batch: DataFrame, batch_id: int) -> None:
        _append_history(batch, output, batch_id)
        with job_folder(spark):
            result = build_training_matrix(_read_history(spark, output), spec, median_method=median_method, materialize="checkpoint")
            train_path, val_path = write_matrices(result.train, result.validation, output, fmt)
        log.info("batch %s rebuilt matrices: %s", batch_id, result.metrics.get(timeout=60))
        if model_output:
            # the arrival also retrains: one model version per processed batch
            report = train_job(spark, train_path, val_path, model_output, spec, fmt,
                               version=f"batch-{batch_id:06d}", **(model_params or {}))
            log.info("batch %s model: %s", batch_id, report.get("model_path") or report.get("skipped"))

    return process


def fit_version(output: str, batch_id: int) -> str:
    return f"{fit_path(output)}/version={batch_id:012d}"


def publish_fit(spark: SparkSession, result, output: str, batch_id: int) -> None:
    """Store the fit in a folder of its own; the marker, written last, makes it visible."""
    base = fit_version(output, batch_id)
    result.labels.save(f"{base}/labels")
    spark.createDataFrame([(result.imputer.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/imputer")
    files.write_text(spark, f"{base}/published", base)


def adopt_fit(spark: SparkSession, result, output: str) -> None:
    """Freeze a fit made elsewhere (the result of a batch build) before the first arrival, in place of one on it."""
    publish_fit(spark, result, output, 0)


def published_fit(spark: SparkSession, output: str) -> str | None:
    """Folder of the newest published fit; one without a marker was never finished and is passed over.
    Only a missing folder counts as nothing published: other faults are raised."""
    base = fit_path(output)
    done = [v for v in files.children(spark, base) if v.startswith("version=") and files.exists(spark, f"{base}/{v}/published")]
    return f"{base}/{max(done)}" if done else None


def load_frozen_fit(spark: SparkSession, output: str, spec: PanelSpec) -> tuple[ImputerStats, LabelModel] | None:
    base = published_fit(spark, output)
    if base is None:
        return None
    text = spark.read.text(f"{base}/imputer").first()["value"]
    labels = LabelModel.load(spark, f"{base}/labels", [c for c in spec.categoricals])
    return ImputerStats.from_json(text), labels


def _incremental_batch(spark, output, spec, median_method, fmt, buckets, months):
    store = SeriesStore(spark, output, spec, buckets, fmt, months)

    def process(batch: DataFrame, batch_id: int) -> None:
        _append_history(batch, output, batch_id)
        fit = load_frozen_fit(spark, output, spec)
        if fit is None:
            with job_folder(spark):
                result = build_training_matrix(_read_history(spark, output), spec, median_method=median_method)
                if not any(result.labels.sizes.values()):
                    log.info("batch %s: no complete training row yet, history kept", batch_id)
                    return
                publish_fit(spark, result, output, batch_id)
            fit = load_frozen_fit(spark, output, spec)
        # the first batch after the fit brings in all that was kept before it
        first = store.started() in (None, batch_id)
        rows = _read_history(spark, output) if first else _history_of(spark, output, batch_id)
        log.info("batch %s: %s", batch_id, store.add(rows, *fit, batch_id))

    return process


def on_arrival(spark: SparkSession, input_dir: str, output: str, checkpoint: str, spec: PanelSpec = RETAIL,
               median_method: str = "exact", fmt: str = "parquet", available_now: bool = True,
               max_files_per_trigger: int | None = None, mode: str = "full", buckets: int = 256,
               model_output: str | None = None, model_params: dict | None = None, months: int = 1) -> StreamingQuery:
    """Start the file-arrival stream; ``available_now`` processes what is there and stops.
    Incremental tables are partitioned by ``buckets`` of series and periods of ``months``.

    With ``model_output`` (full mode), each processed batch also trains and saves a model
    version (``<model_output>/batch-<id>``), as the arrival event's training step.
    """
    if mode == "full":
        fn = _full_batch(spark, output, spec, median_method, fmt, model_output, model_params)
    elif mode == "incremental":
        fn = _incremental_batch(spark, output, spec, median_method, fmt, buckets, months)
    else:
        raise ValueError(f"mode must be 'full' or 'incremental', got {mode!r}")
    # the stream finds the new files by their paths (their content is not read here); their rows
    # come through the batch reader, by header name
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def process(found: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in found.collect()]  # one row a file, as in Spark's own listing
        fn(read_panel(found.sparkSession, paths) if paths else spark.createDataFrame([], RAW_SCHEMA), batch_id)

    found = reader.load(input_dir).select("path")
    writer = found.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
