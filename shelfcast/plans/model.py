"""Training, evaluation and persistence of the demand model with Spark ML.

Boosted regression trees with squared loss (100 rounds, depth 6, step 0.2 by default).
Spark's GBT is not the same solver as a second-order boosting library, so compare
error levels (RMSE), never individual predictions.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.plans import trees
from shelfcast.sources import files
from shelfcast.spec import RETAIL, PanelSpec

# Boosting hyperparameters and the version-stamp format.
NUM_ROUNDS = 100
MAX_DEPTH = 6
STEP_SIZE = 0.2
VERSION_FORMAT = "%Y%m%d-%H%M%S"


def feature_cols(spec: PanelSpec = RETAIL) -> list[str]:
    return list(spec.output_cols[1:])


def training_pipeline(spec: PanelSpec = RETAIL, rounds: int = NUM_ROUNDS, depth: int = MAX_DEPTH,
                      step: float = STEP_SIZE, seed: int = 42, max_bins: int = 32,
                      subsampling_rate: float = 1.0) -> Pipeline:
    """Assembler + GBT. Encoded categoricals are plain doubles (no nominal metadata),
    so trees split them as ordered numbers, as a CSV-fed trainer does."""
    assembler = VectorAssembler(inputCols=feature_cols(spec), outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(
        labelCol=spec.target, featuresCol="features", predictionCol="prediction",
        maxIter=rounds, maxDepth=depth, stepSize=step, lossType="squared",
        seed=seed, maxBins=max_bins, subsamplingRate=subsampling_rate,
    )
    return Pipeline(stages=[assembler, gbt])


def train_model(train: DataFrame, spec: PanelSpec = RETAIL, **params) -> PipelineModel:
    return training_pipeline(spec, **params).fit(train)


# The matrix column that feeds each of the 12 serving features, in payload order.
SERVING_FROM_MATRIX = {
    "store_id_encoded": "Store ID",
    "item_id_encoded": "Product ID",
    "day_of_week": "day_of_week",
    "day_of_month": "day_of_month",
    "month": "month",
    "year": "year",
    "is_weekend": "is_weekend",
    "lag_1_sales": "demand_lag_1",
    "lag_7_sales": "demand_lag_7",
    "rolling_mean_7": "demand_roll_mean_7",
    "price": "Price",
    "promo": "Promotion",
}


def serving_frame(matrix: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """The training matrix seen through the 12-feature serving schema (target kept)."""
    return matrix.select(F.col(f"`{spec.target}`"),
                         *[F.col(f"`{src}`").cast("double").alias(dst) for dst, src in SERVING_FROM_MATRIX.items()])


def train_serving_model(matrix: DataFrame, spec: PanelSpec = RETAIL, rounds: int = NUM_ROUNDS,
                        depth: int = MAX_DEPTH, step: float = STEP_SIZE, seed: int = 42) -> PipelineModel:
    """A model over exactly the features the request path sends, so request scoring can
    use a trained Spark model (the 29-feature matrix model cannot read serving rows)."""
    assembler = VectorAssembler(inputCols=list(SERVING_FROM_MATRIX), outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(labelCol=spec.target, featuresCol="features", predictionCol="prediction",
                       maxIter=rounds, maxDepth=depth, stepSize=step, lossType="squared", seed=seed)
    return Pipeline(stages=[assembler, gbt]).fit(serving_frame(matrix, spec))


def rmse(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(scored)


def rmse_frame(df: DataFrame, label: str, prediction: str, name: str = "rmse") -> DataFrame:
    """One-row RMSE as a lazy aggregate (rows with a null prediction are skipped)."""
    err = F.col(label) - F.col(prediction)
    return df.where(F.col(prediction).isNotNull()).agg(F.sqrt(F.avg(err * err)).alias(name))


def rmse_per_round(model: PipelineModel, df: DataFrame, spec: PanelSpec = RETAIL) -> list[float]:
    """RMSE after each boosting round (the per-round evaluation log of a boosting job), from one scan."""
    return trees.rmse_per_round(model, df, spec.target)


@dataclass
class Evaluation:
    train_rmse: float
    validation_rmse: float
    baseline_rmse: float | None = None


def evaluate(model: PipelineModel, train: DataFrame, validation: DataFrame, spec: PanelSpec = RETAIL,
             baseline_col: str | None = "demand_lag_7") -> Evaluation:
    t = rmse(model.transform(train), spec.target)
    v = rmse(model.transform(validation), spec.target)
    b = None
    if baseline_col and baseline_col in validation.columns:
        row = rmse_frame(validation, spec.target, baseline_col).first()
        b = row[0] if row else None
    return Evaluation(t, v, b)


def version_stamp(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime(VERSION_FORMAT)


#: File of a version folder that is written last: a version without it was never finished.
PUBLISHED = "_published"


def save_model(model: PipelineModel, output: str, version: str | None = None, extra: dict | None = None) -> str:
    """Write the model under ``<output>/<UTC version stamp>``; returns that path. The version counts once its marker is there."""
    path = f"{output.rstrip('/')}/{version or version_stamp()}"
    spark = SparkSession.getActiveSession()
    files.remove(spark, f"{path}/{PUBLISHED}")  # a version written again is unfinished meanwhile
    model.write().overwrite().save(f"{path}/model")
    if extra is not None:
        spark.createDataFrame([(json.dumps(extra, sort_keys=True),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/meta")
    files.write_text(spark, f"{path}/{PUBLISHED}", path)
    return path


def load_model(path: str) -> PipelineModel:
    """A published version's model; one whose save did not finish is refused."""
    if not files.exists(SparkSession.getActiveSession(), f"{path.rstrip('/')}/{PUBLISHED}"):
        raise ValueError(f"{path}: no {PUBLISHED}, the model's save did not finish")
    return PipelineModel.load(f"{path.rstrip('/')}/model")


def latest_model(output: str) -> str | None:
    """Path of the newest published version below ``output`` (versions sort by name); None if there is none."""
    spark, base = SparkSession.getActiveSession(), output.rstrip("/")
    done = [v for v in files.children(spark, base) if files.exists(spark, f"{base}/{v}/{PUBLISHED}")]
    return f"{base}/{max(done)}" if done else None


def train_job(spark: SparkSession, train_path: str, validation_path: str, output: str, spec: PanelSpec = RETAIL,
              fmt: str = "csv", rounds: int = NUM_ROUNDS, depth: int = MAX_DEPTH, step: float = STEP_SIZE,
              version: str | None = None, check: bool = True) -> dict:
    """Read the two matrix channels, train, evaluate per round on both, save a versioned model. ``check=False`` takes
    matrix files made elsewhere, without a manifest."""
    from shelfcast.session import reliable_checkpoint
    from shelfcast.sources.panel import read_matrix

    train = reliable_checkpoint(read_matrix(spark, train_path, spec, fmt, check))
    val = read_matrix(spark, validation_path, spec, fmt, check)
    if train.isEmpty():  # e.g. a first arrival shorter than the lag warm-up
        return {"skipped": "empty training matrix", "model_path": None}
    model = train_model(train, spec, rounds=rounds, depth=depth, step=step)
    report = {
        "train_rmse_per_round": rmse_per_round(model, train, spec),
        "validation_rmse_per_round": rmse_per_round(model, val, spec),
        "rounds": rounds, "depth": depth, "step": step,
    }
    report["model_path"] = save_model(model, output, version, extra=report)
    return report


def main(argv=None) -> None:
    import argparse

    ap = argparse.ArgumentParser(description="Train the demand model on written matrices")
    ap.add_argument("--train", required=True)
    ap.add_argument("--validation", required=True)
    ap.add_argument("--output", required=True, help="base folder; the model goes to <output>/<UTC stamp>")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--rounds", type=int, default=NUM_ROUNDS)
    ap.add_argument("--depth", type=int, default=MAX_DEPTH)
    ap.add_argument("--step", type=float, default=STEP_SIZE)
    ap.add_argument("--unchecked", action="store_true", help="matrix files made elsewhere, without a manifest")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("shelfcast-train").getOrCreate()
    report = train_job(spark, args.train, args.validation, args.output, RETAIL, args.format,
                       args.rounds, args.depth, args.step, check=not args.unchecked)
    summary = {k: v for k, v in report.items() if not k.endswith("per_round")}
    if report.get("validation_rmse_per_round"):
        summary["final_validation_rmse"] = report["validation_rmse_per_round"][-1]
    print(json.dumps(summary))


if __name__ == "__main__":
    main()
