"""Batch job: raw panel files -> train / validation matrices (and optionally a model).

    python -m shelfcast.plans.etl --input <dir> --output <dir> [--cutoff 2024-01-01]

Jobs: the typed input staged once, median passes over its numeric columns, one mode aggregate, the
complete panel staged by split, one label aggregate, two writes. Staged tables lie in the
session's checkpoint folder while the job runs. Row
counts come from observations attached to the plan, not from extra count jobs. The
session is never stopped here: it belongs to the caller.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from shelfcast.plans.training import build_training_matrix
from shelfcast.session import ensure_checkpoint_dir, job_folder
from shelfcast.sources.panel import read_panel, write_matrices
from shelfcast.spec import RETAIL, PanelSpec

log = logging.getLogger("shelfcast.etl")


def run(spark: SparkSession, input_uri: str, output_uri: str, spec: PanelSpec = RETAIL,
        median_method: str = "exact", fmt: str = "csv", single_file: bool = False,
        materialize: str = "checkpoint", order: str = "none") -> dict:
    ensure_checkpoint_dir(spark)
    with job_folder(spark):  # what the job stages is deleted at its end
        raw = read_panel(spark, input_uri)
        result = build_training_matrix(raw, spec, median_method=median_method, materialize=materialize, order=order)
        train_path, val_path = write_matrices(result.train, result.validation, output_uri, fmt, single_file, order != "none")
        fit_dir = save_fit(spark, result, output_uri)
    report = {
        "fit": fit_dir,
        "train": train_path,
        "validation": val_path,
        "medians": result.imputer.medians,
        "modes": result.imputer.modes,
        "labels": result.labels.sizes,
        "rows": result.metrics.get(timeout=60),
        "columns": len(spec.output_cols),
    }
    log.info("pipeline complete: %s", json.dumps(report, default=str))
    return report


def save_fit(spark: SparkSession, result, output_uri: str) -> str:
    """Persist the fitted state next to the matrices: imputer statistics (JSON text) and
    the label table (Parquet), so scoring and later runs can reuse them."""
    base = f"{output_uri.rstrip('/')}/_fit"
    result.labels.save(f"{base}/labels")
    spark.createDataFrame([(result.imputer.to_json(),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{base}/imputer")
    return base


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Demand-forecasting feature pipeline")
    ap.add_argument("--input", required=True, help="raw panel CSV file or folder")
    ap.add_argument("--output", required=True, help="base folder for train/ and validation/")
    ap.add_argument("--cutoff", default=RETAIL.cutoff, help="first validation day (yyyy-MM-dd)")
    ap.add_argument("--week-start", default=RETAIL.week_start, choices=["monday0", "sunday0"])
    ap.add_argument("--median", default="exact", choices=["approx", "exact"])
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--order", default="none", choices=["none", "partition", "global"])
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("shelfcast-etl").getOrCreate()
    spec = RETAIL.with_(cutoff=args.cutoff, week_start=args.week_start)
    print(json.dumps(run(spark, args.input, args.output, spec, args.median, args.format, args.single_file,
                         order=args.order), default=str))


if __name__ == "__main__":
    main()
