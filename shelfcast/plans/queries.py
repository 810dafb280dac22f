"""Registered queries: each operator run on the panels derived from the supplied tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
tables. Fit steps (medians, modes, labels) run their own small aggregate jobs when the
query is built, as a fit does. Columns whose value depends on floating-point
summation order (sample std over a frame) are rounded to 6 decimals so any engine
can check them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators import stats
from shelfcast.operators.encode import apply_labels, drop_unseen, fit_labels
from shelfcast.operators.features import (
    calendar_features,
    engineer_features,
    lag_features,
    price_features,
    rolling_features,
    series_window,
)
from shelfcast.operators.impute import apply_imputer, fill_categorical, fill_numeric, fit_imputer
from shelfcast.operators.shaping import assemble_output, cast_numeric, drop_leaky, parse_date, prepare_raw
from shelfcast.operators.split import drop_incomplete, sort_by_date, split_train, split_validation
from shelfcast.plans import scoring as S
from shelfcast.plans.training import build_training_matrix
from shelfcast.plans.history import KNOWN, attach_history, attach_matrix_features, matrix_day_features, matrix_known
from shelfcast.sources.fixtures import demand_panel, demand_panel_raw, forecast_requests, history_requests, line_items
from shelfcast.session import ensure_checkpoint_dir, reliable_checkpoint, staged
from shelfcast.sources.panel import read_matrix, read_panel, write_matrix
from shelfcast.spec import RETAIL
from shelfcast.streaming.arrival import adopt_fit, on_arrival

# Fixed value: the split date used with the panel derived from the supplied tables
# (its dates run from 1995 to 2001).
PANEL_CUTOFF = "2000-01-01"
SPEC = RETAIL.with_(cutoff=PANEL_CUTOFF)
SPEC_SUNDAY0 = SPEC.with_(week_start="sunday0")
KEYS = ["Store ID", "Product ID", "Date"]
#: Rows a chunk of ``lags_with_ties``: small, so that the query is cut into chunks at every scale.
HOT_TIES = 25
ROUNDED = ("demand_roll_std_7", "demand_roll_std_30")


def _q(c: str):
    return F.col(f"`{c}`")


def _round_inexact(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(_q(c), 6) for c in ROUNDED if c in df.columns})


# ------------------------------------------------------------------ shared stages

def typed_panel(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_raw(demand_panel_raw(spark, sf), SPEC)


def _imputed(spark: SparkSession, sf: str, method: str = "exact"):
    # the fits pass over the panel several times: derived from the line items once
    typed = staged(typed_panel(spark, sf), "typed")
    fitted = fit_imputer(typed, SPEC, method)
    return apply_imputer(typed, fitted), fitted


def imputed_panel(spark: SparkSession, sf: str, method: str = "exact") -> DataFrame:
    return _imputed(spark, sf, method)[0]


def featured_panel(spark: SparkSession, sf: str, spec=SPEC) -> DataFrame:
    imputed, fitted = _imputed(spark, sf)
    return engineer_features(imputed, spec, fitted.series_totals)


def complete_panel(spark: SparkSession, sf: str) -> DataFrame:
    return drop_incomplete(featured_panel(spark, sf), SPEC)


def _staged_complete(spark: SparkSession, sf: str) -> DataFrame:
    """The complete panel, computed once for queries that read it more than once."""
    return staged(complete_panel(spark, sf), "complete")


def _encoded(spark: SparkSession, sf: str, unseen: str = "index"):
    complete = _staged_complete(spark, sf)
    train, val = split_train(complete, SPEC), split_validation(complete, SPEC)
    model = fit_labels(train, SPEC)
    return apply_labels(train, model, "index"), apply_labels(val, model, unseen), model


# ------------------------------------------------------------------ 2.1 shaping

def q_demand_panel(spark, sf):
    return demand_panel(spark, sf)


def q_drop_leaky(spark, sf):
    return drop_leaky(demand_panel_raw(spark, sf), SPEC)


def q_cast_numeric(spark, sf):
    return cast_numeric(drop_leaky(demand_panel_raw(spark, sf), SPEC), SPEC)


def q_parse_date(spark, sf):
    raw = demand_panel_raw(spark, sf, with_bad_dates=True)
    return parse_date(raw, SPEC, col="Date_bad").select("Store ID", "Product ID", "Date", "Date_bad")


def q_assemble_output(spark, sf):
    return _round_inexact(assemble_output(complete_panel(spark, sf), SPEC))


#: Observation -> column of ``row_metrics``, at the eight points of the pipeline.
METRIC_NAMES = {"raw": "rows_raw", "imputed": "rows_imputed", "before_drop": "rows_before_drop", "after_drop": "rows_after_drop",
                "train_before_encoding": "train_rows", "validation_before_encoding": "validation_rows",
                "train": "train_rows_encoded", "validation": "validation_rows_encoded"}


def q_row_metrics(spark, sf):
    """The eight row counts, as the observations of one pipeline run give them."""
    result = build_training_matrix(demand_panel_raw(spark, sf), SPEC, median_method="exact", materialize="checkpoint")
    for matrix in (result.train, result.validation):
        matrix.write.format("noop").mode("overwrite").save()
    rows = {k: v["rows"] for k, v in result.metrics.get(timeout=60).items()}
    return spark.createDataFrame([tuple(int(rows[k]) for k in METRIC_NAMES)], ", ".join(f"{c} bigint" for c in METRIC_NAMES.values()))


# ------------------------------------------------------------------ 2.2 statistics

def _stat_frame(spark, values: dict) -> DataFrame:
    # the fitted values are a handful of scalars: one row per column
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "column string, median double")


def q_median_exact(spark, sf):
    typed = typed_panel(spark, sf)
    return _stat_frame(spark, stats.exact_medians(typed, list(SPEC.typed_numerics)))


def q_median_approx(spark, sf):
    """Per column: rows counted, and whether the approximate median's rank is within 0.001 of the middle."""
    typed = typed_panel(spark, sf)
    cols = list(SPEC.typed_numerics)
    found = _stat_frame(spark, stats.approx_medians(typed, cols)).withColumnRenamed("column", "name")
    long = stats.to_long(typed, cols, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    r = (long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(found), "name")
         .groupBy(F.col("name").alias("column")).agg(
             F.sum("n").cast("bigint").alias("n_values"), F.sum(F.when(F.col("value") < F.col("median"), F.col("n")).otherwise(0)).alias("below"),
             F.sum(F.when(F.col("value") <= F.col("median"), F.col("n")).otherwise(0)).alias("upto")))
    middle, slack = F.floor((F.col("n_values") + 1) / 2), F.lit(0.001) * F.col("n_values")
    return r.select("column", "n_values", ((F.col("below") + 1 - slack <= middle) & (middle <= F.col("upto") + slack)).alias("within"))


def q_modes(spark, sf):
    found = stats.modes(typed_panel(spark, sf), list(SPEC.categoricals))
    return spark.createDataFrame(list(found.items()), "column string, mode string")


def q_value_counts(spark, sf):
    return stats.value_counts(typed_panel(spark, sf), "Category")


# ------------------------------------------------------------------ 2.3 null handling

def q_fill_numeric(spark, sf):
    typed = typed_panel(spark, sf)
    return fill_numeric(typed, stats.exact_medians(typed, list(SPEC.typed_numerics)))


def q_fill_categorical(spark, sf):
    typed = typed_panel(spark, sf)
    return fill_categorical(typed, stats.modes(typed, list(SPEC.categoricals)))


def q_impute_missing(spark, sf):
    return imputed_panel(spark, sf)


# ------------------------------------------------------------------ 2.4-2.6 features

def _keyed_panel(spark, sf):
    """The typed panel with its two keys filled; calendar columns need no other statistic."""
    typed = typed_panel(spark, sf)
    return fill_categorical(typed, stats.modes(typed, list(SPEC.series_keys)))


def q_dow_monday0(spark, sf):
    cal = calendar_features(SPEC)
    return _keyed_panel(spark, sf).select(*[_q(c) for c in KEYS], cal["day_of_week"].alias("day_of_week"),
                                          cal["is_weekend"].alias("is_weekend"))


def q_dow_sunday0(spark, sf):
    cal = calendar_features(SPEC_SUNDAY0)
    return _keyed_panel(spark, sf).select(*[_q(c) for c in KEYS], cal["day_of_week"].alias("day_of_week"),
                                          cal["is_weekend"].alias("is_weekend"))


def q_calendar_parts(spark, sf):
    cal = calendar_features(SPEC)
    names = ["day_of_month", "week_of_year", "month", "quarter", "year"]
    return _keyed_panel(spark, sf).select(*[_q(c) for c in KEYS], *[cal[n].alias(n) for n in names])


def q_price_features(spark, sf):
    pf = price_features(SPEC)
    return typed_panel(spark, sf).select(*[_q(c) for c in KEYS], *[v.alias(k) for k, v in pf.items()])


def _windowed(spark, sf, columns):
    typed = typed_panel(spark, sf)
    cols = columns(SPEC, series_window(SPEC, columns=typed.columns))
    return typed, cols


def q_demand_lags(spark, sf):
    typed, lags = _windowed(spark, sf, lag_features)
    return typed.select(*[_q(c) for c in KEYS], *[v.alias(k) for k, v in lags.items()])


def q_rolling_mean(spark, sf):
    typed, roll = _windowed(spark, sf, rolling_features)
    return typed.select(*[_q(c) for c in KEYS], *[v.alias(k) for k, v in roll.items() if "mean" in k])


def q_rolling_std(spark, sf):
    typed, roll = _windowed(spark, sf, rolling_features)
    return _round_inexact(typed.select(*[_q(c) for c in KEYS], *[v.alias(k) for k, v in roll.items() if "std" in k]))


def q_lags_with_ties(spark, sf):
    """Lags over single line items, many of which share series and day: the total order (date, then
    every other column) decides, however a series is cut."""
    spec = SPEC.with_(hot_series_rows=HOT_TIES, windows=(7,))
    lines = line_items(spark, sf)
    out = engineer_features(lines, spec)
    return out.select(*lines.columns, *[c for c in out.columns if c.startswith(("demand_lag", "demand_roll_mean"))])


def q_engineer_features(spark, sf):
    return _round_inexact(featured_panel(spark, sf))


def q_engineer_features_sunday0(spark, sf):
    return _round_inexact(featured_panel(spark, sf, SPEC_SUNDAY0))


# ------------------------------------------------------------------ 2.7 filter / split

def q_drop_incomplete(spark, sf):
    return _round_inexact(complete_panel(spark, sf))


def q_split_train(spark, sf):
    return _round_inexact(split_train(complete_panel(spark, sf), SPEC))


def q_split_validation(spark, sf):
    return _round_inexact(split_validation(complete_panel(spark, sf), SPEC))


# ------------------------------------------------------------------ 2.8 encoding

def q_label_map(spark, sf):
    return fit_labels(split_train(complete_panel(spark, sf), SPEC), SPEC).labels


def q_encode_train(spark, sf):
    return _round_inexact(_encoded(spark, sf)[0])


def q_encode_validation(spark, sf):
    return _round_inexact(drop_unseen(_encoded(spark, sf)[1], SPEC))


def q_encode_validation_drop(spark, sf):
    return _round_inexact(_encoded(spark, sf, unseen="drop")[1])


# ------------------------------------------------------------------ 2.9 whole pipeline

def q_training_matrix(spark, sf):
    return _round_inexact(assemble_output(_encoded(spark, sf)[0], SPEC))


def q_validation_matrix(spark, sf):
    return _round_inexact(assemble_output(drop_unseen(_encoded(spark, sf)[1], SPEC), SPEC))


# ------------------------------------------------------------------ 2.10 training / evaluation

def q_rmse_baseline(spark, sf):
    """RMSE of the naive forecast ``demand_lag_7`` on the validation matrix."""
    from shelfcast.plans.model import rmse_frame

    val = assemble_output(drop_unseen(_encoded(spark, sf)[1], SPEC), SPEC)
    return rmse_frame(val, SPEC.target, "demand_lag_7", "rmse_baseline")


def _checkpointed_matrices(spark, sf):
    """Both matrices, computed once: boosting reads its input every round."""
    train, val, _ = _encoded(spark, sf)
    return (reliable_checkpoint(assemble_output(train, SPEC)), reliable_checkpoint(assemble_output(drop_unseen(val, SPEC), SPEC)))


def model_rmse_values(spark, sf):
    """RMSE of the operator's own model on both parts, beside the naive forecast's: trained values, so
    no registered query (``model_rmse`` returns what SQL can state)."""
    from shelfcast.plans.model import evaluate, train_model

    train, val = _checkpointed_matrices(spark, sf)
    return evaluate(train_model(train, SPEC), train, val, SPEC)


def q_model_rmse(spark, sf):
    """Train boosted trees, save and reload the model; one row of properties: rows of both matrices,
    whether the model beats the naive ``demand_lag_7`` forecast on validation, and whether the
    reloaded model predicts the same. Each matrix is scored once a model."""
    from shelfcast.plans.model import load_model, save_model, train_model

    train, val = _checkpointed_matrices(spark, sf)
    model = train_model(train, SPEC)
    again = load_model(save_model(model, f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"))
    scored = again.transform(model.transform(val).withColumnRenamed("prediction", "first").drop("features"))
    err = lambda c: F.sqrt(F.avg((F.col(SPEC.target) - F.col(c)) ** 2))
    return scored.agg(F.lit(train.count()).cast("bigint").alias("train_rows"), F.count(F.lit(1)).alias("validation_rows"),
                      (err("prediction") < err("demand_lag_7")).alias("beats_naive"),
                      (F.max(F.abs(F.col("prediction") - F.col("first"))) == 0).alias("reload_agrees"))


def q_matrix_round_trip(spark, sf):
    """The training matrix written as headerless CSV and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/matrix-{uuid.uuid4().hex}"
    write_matrix(_round_inexact(assemble_output(_encoded(spark, sf)[0], SPEC)), path)
    return read_matrix(spark, path, SPEC)


def q_panel_round_trip(spark, sf):
    """The raw panel written as CSV files with two column orders and read back by header name."""
    path = f"{ensure_checkpoint_dir(spark)}/panel-{uuid.uuid4().hex}"
    raw = demand_panel_raw(spark, sf)
    early = F.col("Date") < "1998-01-01"
    raw.where(early).write.option("header", True).csv(f"{path}/a")
    raw.where(~early).select(*reversed(raw.columns)).write.option("header", True).csv(f"{path}/b")
    return read_panel(spark, f"{path}/*")


def q_arrival_matrix(spark, sf):
    """The training matrix after two arrivals, the first too short for any complete row (incremental
    mode: nothing is fitted or written before the second)."""
    base = f"{ensure_checkpoint_dir(spark)}/arrival-{uuid.uuid4().hex}"
    raw = demand_panel_raw(spark, sf)
    start = raw.select(F.min(F.to_date("Date"))).first()[0]
    head = F.to_date("Date") < F.date_add(F.lit(start), 20)
    raw.where(head).coalesce(1).write.option("header", True).csv(f"{base}/in/a")
    raw.where(~head).select(*reversed(raw.columns)).coalesce(1).write.option("header", True).csv(f"{base}/in/b")
    query = on_arrival(spark, f"{base}/in/*", f"{base}/out", f"{base}/progress", SPEC, median_method="exact",
                       max_files_per_trigger=1, mode="incremental", buckets=4, months=12)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return _round_inexact(spark.read.parquet(f"{base}/out/train").select(*[_q(c) for c in SPEC.output_cols]))


def q_late_arrival_matrix(spark, sf):
    """The training matrix after three arrivals, each with days out of order all over the panel's time (incremental
    mode, frozen fit of the whole panel): every later arrival's rows enter the middle of their series."""
    base = f"{ensure_checkpoint_dir(spark)}/late-{uuid.uuid4().hex}"
    raw = demand_panel_raw(spark, sf)
    deal = F.pmod(F.xxhash64("Date"), F.lit(8))
    # half of the days first, then the other half in two parts
    for name, part in (("a", deal < 4), ("b", deal.isin(4, 5)), ("c", deal > 5)):
        raw.where(part).coalesce(1).write.option("header", True).csv(f"{base}/in/{name}")
    adopt_fit(spark, build_training_matrix(raw, SPEC), f"{base}/out")
    query = on_arrival(spark, f"{base}/in/*", f"{base}/out", f"{base}/progress", SPEC, max_files_per_trigger=1, mode="incremental", buckets=4, months=12)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return _round_inexact(spark.read.parquet(f"{base}/out/train").select(*[_q(c) for c in SPEC.output_cols]))


def q_sorted_export(spark, sf):
    """The training matrix exported in date order, all columns, read back: rows a day, whether the files keep the order, and whether
    each day's rows are those of the matrix (by a sum of row hashes)."""
    train = split_train(_staged_complete(spark, sf), SPEC)
    path = f"{ensure_checkpoint_dir(spark)}/sorted-{uuid.uuid4().hex}"
    sort_by_date(train, SPEC).write.parquet(path)
    # files and rows in them keep the order written: a day never comes after a later one
    back = spark.read.parquet(path)
    rows = back.select("Date", F.xxhash64(*[_q(c) for c in train.columns]).alias("h"), F.col("_metadata.file_name").alias("f"))
    span = rows.groupBy("f").agg(F.min("Date").alias("lo"), F.max("Date").alias("hi"))
    w = Window.orderBy("f")  # one row a file
    bad = span.select((F.lag("hi").over(w) > F.col("lo")).alias("bad")).agg(F.coalesce(F.max("bad"), F.lit(False)).alias("bad"))
    # decimal sums: of hashes a long would overflow
    days = lambda df: df.groupBy("Date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("hash"))
    want = days(train.select("Date", F.xxhash64(*[_q(c) for c in train.columns]).alias("h"))).withColumnRenamed("n_rows", "_n").withColumnRenamed("hash", "_hash")
    both = days(rows).join(want, "Date", "full").join(F.broadcast(bad))
    same = F.coalesce((F.col("n_rows") == F.col("_n")) & (F.col("hash") == F.col("_hash")), F.lit(False))
    return both.select("Date", "n_rows", (~F.col("bad")).alias("in_order"), same.alias("same_rows"))


# ------------------------------------------------------------------ 2.11 request scoring

def stand_in_forecast(d):
    """Deterministic stand-in for a model: day of month + month / 100."""
    return F.dayofmonth(d).cast("double") + F.month(d) / F.lit(100.0)


#: First texts of some replies: no number, three that only some parsers take, and NaN.
ODD_REPLIES = ("n/a", "1.5d", "0x1p3", "1_000", "nan")


def stand_in_replies(valid: DataFrame) -> DataFrame:
    """Newline-separated reply text per valid request, as an external scorer returns it.
    Every 11th request gets one value fewer than days, every 13th an odd first text."""
    h = F.col("horizon").cast("int")
    vals = F.transform(F.sequence(F.lit(1), h), lambda i: stand_in_forecast(F.date_add(F.col("date"), i)).cast("string"))
    rid = F.col("request_id")
    vals = F.when(F.pmod(rid, F.lit(11)) == 0, F.slice(vals, 1, h - 1)).otherwise(vals)
    n = F.size(vals)
    odd = F.get(F.array(*[F.lit(x) for x in ODD_REPLIES]), F.pmod(F.floor(rid / 13), F.lit(len(ODD_REPLIES))).cast("int"))
    vals = F.when((F.pmod(rid, F.lit(13)) == 0) & (n > 0),
                  F.concat(F.array(odd), F.slice(vals, 2, n - 1))).otherwise(vals)
    return valid.select("request_id", F.concat(F.array_join(vals, "\n"), F.lit("\n")).alias("reply"))


def _n_predictions():
    # null for requests without predictions, whatever the session's legacy size(null) setting
    return F.when(F.col("predictions").isNotNull(), F.size("predictions")).alias("n_predictions")


def _validated(spark, sf):
    return S.validate_requests(forecast_requests(spark, sf))


def _valid(spark, sf):
    return S.valid_requests(_validated(spark, sf))


def q_parse_requests(spark, sf):
    return S.parse_requests(forecast_requests(spark, sf)).select("request_id", "parse_status", "parse_error")


def q_validate_requests(spark, sf):
    return _validated(spark, sf).select("request_id", "status", "error", "store_id", "item_id", "date", "horizon",
                                        "horizon_defaulted")


def q_default_horizon(spark, sf):
    return _valid(spark, sf).where(F.col("horizon_defaulted")).select("request_id", "horizon")


def q_rejected_requests(spark, sf):
    return S.rejected_requests(_validated(spark, sf)).select("request_id", "status", "error")


def q_horizon_expand(spark, sf):
    return S.expand_horizon(_valid(spark, sf)).select("request_id", "day", "forecast_date")


def q_serving_calendar(spark, sf):
    cal = S.serving_calendar(F.col("forecast_date"))
    return S.expand_horizon(_valid(spark, sf)).select("request_id", "day", *[v.alias(k) for k, v in cal.items()])


def q_serving_features(spark, sf):
    return S.serving_features(S.expand_horizon(_valid(spark, sf))).select("request_id", "day", *S.SERVING_FEATURES)


def q_payload_csv(spark, sf):
    return S.payload_csv(_valid(spark, sf))


def q_parse_predictions(spark, sf):
    parsed = S.parse_predictions(stand_in_replies(_valid(spark, sf)))
    return parsed.select("request_id", "prediction_error", F.posexplode_outer("predictions").alias("pos", "forecast"))


def _reply_responses(spark, sf):
    # read for the replies and again for the responses: the bodies are parsed once
    validated = staged(_validated(spark, sf), "validated")
    return S.assemble_responses(S.attach_replies(validated, stand_in_replies(S.valid_requests(validated))))


def q_zip_predictions(spark, sf):
    resp = _reply_responses(spark, sf).where(F.col("status") == 200)
    return resp.select("request_id", F.inline("predictions"))


def q_responses(spark, sf):
    resp = _reply_responses(spark, sf)
    return resp.select("request_id", "status", "error", "store_id", "item_id",
                       _n_predictions(), "response_body")


def q_scored_responses(spark, sf):
    # the stand-in as an expression of the serving features: scored inside each request row
    scorer = S.FeatureExpressionScorer(lambda f: f["day_of_month"] + f["month"] / F.lit(100.0))
    resp = S.score_requests(forecast_requests(spark, sf), scorer)
    return resp.select("request_id", "status", "error", "store_id", "item_id",
                       _n_predictions(), "response_body")


def q_scored_responses_by_row(spark, sf):
    """The same stand-in scored day by day as rows (the path a row-based model takes)."""
    scorer = S.ExpressionScorer(stand_in_forecast(F.col("forecast_date")))
    resp = S.score_requests(forecast_requests(spark, sf), scorer)
    return resp.select("request_id", "status", "error", "store_id", "item_id",
                       _n_predictions(), "response_body")


def q_model_scored_responses(spark, sf):
    """Requests scored by a boosted-tree model (all rounds) trained on the serving view of the matrix, its trees walked
    inside each request row. SQL cannot state the forecasts: the days they stand for, and that all are numbers."""
    from shelfcast.plans.model import train_serving_model
    from shelfcast.plans.trees import TreeEnsemble, TreeScorer

    model = train_serving_model(reliable_checkpoint(q_training_matrix(spark, sf)), SPEC)
    # a hundred trees a day are much work for a short request: dealt out before they are walked
    requests = forecast_requests(spark, sf).repartition("request_id")
    resp = S.score_requests(requests, TreeScorer(TreeEnsemble.of(model), S.serving_feature_columns))
    days = F.col("predictions")
    return resp.select("request_id", "status", "error", _n_predictions(), days[0]["date"].alias("first_date"),
                       F.element_at(days, -1)["date"].alias("last_date"),
                       F.forall(days, lambda p: F.abs(p["forecast"]) < float("inf")).alias("all_finite"))


def q_history_model_responses(spark, sf):
    """Requests scored by the 29-column matrix model (all rounds) on their matrix rows: through day rows by the model itself,
    and walked as data in the same rows. Days per request, and whether both ways agree."""
    from shelfcast.plans.model import train_model
    from shelfcast.plans.training import matrices_from_imputed
    from shelfcast.plans.trees import TreeEnsemble

    imputed, fitted, labels, requests = _fitted_history(spark, sf)
    model = train_model(reliable_checkpoint(matrices_from_imputed(imputed, labels, SPEC)[0]), SPEC)
    trees = TreeEnsemble.of(model)
    rows = attach_matrix_features(requests, imputed, fitted, labels, SPEC)

    def both(days):
        scored = S.ModelScorer(model)(days)
        far = F.abs(F.col("prediction") - trees.prediction([_q(c) for c in trees.inputs])) > 1e-6
        return scored.withColumn("prediction", F.when(far, float("nan")).otherwise(F.col("prediction")))

    resp = S.assemble_responses(S.score_days(rows, both, matrix_known(SPEC), lambda d: matrix_day_features(d, SPEC)))
    return resp.select("request_id", "status", _n_predictions(), F.forall("predictions", lambda p: ~F.isnan(p["forecast"])).alias("agree"))


def _fitted_history(spark, sf):
    """Imputed panel, frozen fit and validated requests for real stores and products."""
    imputed, fitted = _imputed(spark, sf)
    imputed = reliable_checkpoint(imputed)
    labels = fit_labels(split_train(drop_incomplete(engineer_features(imputed, SPEC, fitted.series_totals), SPEC), SPEC), SPEC)
    return imputed, fitted, labels, S.validate_requests(history_requests(spark, sf))


def _with_history(spark, sf):
    """Requests for real stores and products, with features from the imputed panel before their date."""
    imputed, _, labels, requests = _fitted_history(spark, sf)
    return attach_history(requests, imputed, labels, SPEC)


def q_history_matrix_rows(spark, sf):
    """The 29-feature matrix row of every forecast day of every valid request, from the frozen fit and the series' history."""
    imputed, fitted, labels, requests = _fitted_history(spark, sf)
    rows = _round_inexact(attach_matrix_features(requests, imputed, fitted, labels, SPEC))  # once a request, not once a day
    days = matrix_day_features(S.expand_horizon(S.valid_requests(rows)), SPEC)
    return days.select("request_id", "day", *[_q(c) for c in SPEC.output_cols[1:]])


def q_history_lookup(spark, sf):
    return _with_history(spark, sf).select("request_id", "status", *KNOWN)


def q_history_scored_responses(spark, sf):
    """An expression over the history features, scored day by day."""
    expr = F.col("rolling_mean_7") + F.col("lag_1_sales") * 100 + F.col("day_of_month") / 64 + F.col("store_id_encoded")
    resp = S.assemble_responses(S.score_days(_with_history(spark, sf), S.ExpressionScorer(expr), KNOWN))
    return resp.select("request_id", "status", F.inline_outer("predictions")).withColumn("forecast", F.round("forecast", 6))


QUERIES = {
    "demand_panel": q_demand_panel,
    "drop_leaky": q_drop_leaky,
    "cast_numeric": q_cast_numeric,
    "parse_date": q_parse_date,
    "assemble_output": q_assemble_output,
    "row_metrics": q_row_metrics,
    "median_exact": q_median_exact,
    "median_approx": q_median_approx,
    "lags_with_ties": q_lags_with_ties,
    "panel_round_trip": q_panel_round_trip,
    "matrix_round_trip": q_matrix_round_trip,
    "sorted_export": q_sorted_export,
    "arrival_matrix": q_arrival_matrix,
    "late_arrival_matrix": q_late_arrival_matrix,
    "modes": q_modes,
    "value_counts": q_value_counts,
    "fill_numeric": q_fill_numeric,
    "fill_categorical": q_fill_categorical,
    "impute_missing": q_impute_missing,
    "dow_monday0": q_dow_monday0,
    "dow_sunday0": q_dow_sunday0,
    "calendar_parts": q_calendar_parts,
    "price_features": q_price_features,
    "demand_lags": q_demand_lags,
    "rolling_mean": q_rolling_mean,
    "rolling_std": q_rolling_std,
    "engineer_features": q_engineer_features,
    "engineer_features_sunday0": q_engineer_features_sunday0,
    "drop_incomplete": q_drop_incomplete,
    "split_train": q_split_train,
    "split_validation": q_split_validation,
    "label_map": q_label_map,
    "encode_train": q_encode_train,
    "encode_validation": q_encode_validation,
    "encode_validation_drop": q_encode_validation_drop,
    "training_matrix": q_training_matrix,
    "validation_matrix": q_validation_matrix,
    "rmse_baseline": q_rmse_baseline,
    "model_rmse": q_model_rmse,
    "parse_requests": q_parse_requests,
    "validate_requests": q_validate_requests,
    "default_horizon": q_default_horizon,
    "rejected_requests": q_rejected_requests,
    "horizon_expand": q_horizon_expand,
    "serving_calendar": q_serving_calendar,
    "serving_features": q_serving_features,
    "payload_csv": q_payload_csv,
    "parse_predictions": q_parse_predictions,
    "zip_predictions": q_zip_predictions,
    "responses": q_responses,
    "scored_responses": q_scored_responses,
    "scored_responses_by_row": q_scored_responses_by_row,
    "history_lookup": q_history_lookup,
    "history_matrix_rows": q_history_matrix_rows,
    "history_model_responses": q_history_model_responses,
    "history_scored_responses": q_history_scored_responses,
    "model_scored_responses": q_model_scored_responses,
}
