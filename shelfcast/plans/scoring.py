"""Batch scoring of forecast requests as one Spark plan.

requests(request_id, body)
  -> parse + validate (narrow projection over a VARIANT; first failing rule wins)
  -> rejected: status 400 / 500 with the error text
  -> valid, expression scorer: predictions computed inside the request row (no shuffle)
  -> valid, row scorer (e.g. a Spark ML model): one row per forecast day (explode of
     sequence(1, horizon)), serving features, scorer, then predictions regrouped per
     request by a per-request row id (at most 30 rows per group, collapsed map-side)
  -> responses: status, error, store_id, item_id, predictions[{date, forecast}], JSON body

A request that fails never fails the batch: it becomes a row with status 500.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import requests as R
from shelfcast.functions.parsing import request_date

# Serving feature names in payload order and their placeholder values.
SERVING_FEATURES = (
    "store_id_encoded", "item_id_encoded", "day_of_week", "day_of_month", "month", "year",
    "is_weekend", "lag_1_sales", "lag_7_sales", "rolling_mean_7", "price", "promo",
)
SERVING_PLACEHOLDERS = {
    "store_id_encoded": 0.0, "item_id_encoded": 0.0, "lag_1_sales": 0.0, "lag_7_sales": 0.0,
    "rolling_mean_7": 0.0, "price": 50.0, "promo": 0.0,
}


# ------------------------------------------------------------------ S1-S4

def parse_requests(requests: DataFrame, body_col: str = "body") -> DataFrame:
    """Adds ``v`` (VARIANT) and the parse-stage outcome ``parse_status`` / ``parse_error``.

    Malformed JSON -> 400 ``Invalid request body``; a null body or a JSON value that is
    not an object -> 500 ``Inference failed: ...`` (what the handler's outer guard returns).
    """
    body = F.col(body_col)
    v = F.try_parse_json(body)
    with_v = requests.withColumn("v", v)
    t = R.variant_type(F.col("v"))
    status = (
        F.when(body.isNull(), R.STATUS_FAILED)
        .when(F.col("v").isNull(), R.STATUS_BAD_REQUEST)
        .when(t != "OBJECT", R.STATUS_FAILED)
    )
    error = (
        F.when(body.isNull(), F.lit(R.MSG_INFERENCE_FAILED + R.MSG_NULL_BODY))
        .when(F.col("v").isNull(), F.lit(R.MSG_INVALID_BODY))
        .when(t != "OBJECT", F.concat(F.lit(R.MSG_INFERENCE_FAILED + "'"), R.python_type_name(F.col("v")),
                                      F.lit("' object has no attribute 'get'")))
    )
    return with_v.withColumns({"parse_status": status, "parse_error": error})


def validate_requests(requests: DataFrame, body_col: str = "body") -> DataFrame:
    """Adds ``status`` (null while still valid), ``error``, and typed ``store_id``,
    ``item_id``, ``date``, ``horizon``, ``horizon_defaulted``.

    Built in stages (fields, then their types, then the rules) so each variant lookup
    is evaluated once per row and the generated code stays small.
    """
    p = parse_requests(requests, body_col)
    v = F.col("v")
    fields = p.select(
        "*",
        R.field(v, "store_id").alias("_store"), R.field(v, "item_id").alias("_item"),
        R.field(v, "date").alias("_date"), R.field(v, "horizon").alias("_horizon"),
    )
    typed = fields.select(
        "*",
        R.variant_type(F.col("_store")).alias("_store_t"), R.variant_type(F.col("_item")).alias("_item_t"),
        R.variant_type(F.col("_date")).alias("_date_t"), R.variant_type(F.col("_horizon")).alias("_horizon_t"),
    )
    date_text = F.when(F.col("_date_t") == "STRING", F.try_variant_get(F.col("_date"), "$", "string"))
    checks = typed.select(
        "*",
        R.is_truthy(F.col("_store"), F.col("_store_t")).alias("_store_ok"),
        R.is_truthy(F.col("_item"), F.col("_item_t")).alias("_item_ok"),
        request_date(date_text).alias("_date_v"),
        R.horizon_value(F.col("_horizon"), F.col("_horizon_t")).alias("_h"),
    )
    h = F.col("_h")
    h_ok = h.isNotNull() & h.between(R.HORIZON_MIN, R.HORIZON_MAX)
    parsed = F.col("parse_status").isNotNull()
    rule = (
        F.when(parsed, F.lit(0))
        .when(~F.col("_store_ok"), F.lit(1))
        .when(~F.col("_item_ok"), F.lit(2))
        .when(F.col("_date_v").isNull(), F.lit(3))
        .when(~h_ok, F.lit(4))
        # forecast days past 9999-12-31 overflow a Python date: the handler's outer guard answers 500
        .when(F.date_add(F.col("_date_v"), h.cast("int")) > F.lit(R.MAX_DATE).cast("date"), F.lit(5))
    )
    ruled = checks.withColumn("_rule", rule)
    r = F.col("_rule")
    status = (F.when(r == 0, F.col("parse_status")).when(r == 5, F.lit(R.STATUS_FAILED))
              .when(r.isNotNull(), F.lit(R.STATUS_BAD_REQUEST)))
    error = (
        F.when(r == 0, F.col("parse_error"))
        .when(r == 1, F.lit(R.MSG_STORE_REQUIRED))
        .when(r == 2, F.lit(R.MSG_ITEM_REQUIRED))
        .when(r == 3, F.lit(R.MSG_BAD_DATE))
        .when(r == 4, F.lit(R.MSG_BAD_HORIZON))
        .when(r == 5, F.lit(R.MSG_INFERENCE_FAILED + R.MSG_DATE_OVERFLOW))
    )
    outcome = F.struct(
        status.cast("int").alias("status"),
        error.alias("error"),
        R.as_text(F.col("_store"), F.col("_store_t")).alias("store_id"),
        R.as_text(F.col("_item"), F.col("_item_t")).alias("item_id"),
        F.col("_date_v").alias("date"),
        F.when(h_ok & ~parsed, h).alias("horizon"),
        F.col("_horizon").isNull().alias("horizon_defaulted"),
        F.to_json(F.col("_store")).alias("store_json"),
        F.to_json(F.col("_item")).alias("item_json"),
    )
    # The outcome leaves through a one-row generator: a later filter on ``status`` can not
    # be pushed below it, so the JSON is parsed once per row instead of being inlined
    # into the filter condition (which also keeps the generated code small).
    return ruled.select(*[c for c in requests.columns], F.inline(F.array(outcome)))


def valid_requests(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("status").isNull())


def rejected_requests(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("status").isNotNull())


# ------------------------------------------------------------------ S5-S8

def expand_horizon(valid: DataFrame) -> DataFrame:
    """One row per forecast day: ``day`` 1..horizon, ``forecast_date`` = date + day."""
    return valid.select("*", F.explode(F.sequence(F.lit(1), F.col("horizon").cast("int"))).alias("day")).withColumn(
        "forecast_date", F.date_add(F.col("date"), F.col("day"))
    )


def serving_calendar(d: Column) -> dict[str, Column]:
    """Serving-side calendar (Monday=0), all doubles."""
    dow = F.weekday(d)
    return {
        "day_of_week": dow.cast("double"),
        "day_of_month": F.dayofmonth(d).cast("double"),
        "month": F.month(d).cast("double"),
        "year": F.year(d).cast("double"),
        "is_weekend": F.when(dow >= 5, 1.0).otherwise(0.0),
    }


def serving_feature_columns(d: Column, known: tuple[str, ...] = ()) -> dict[str, Column]:
    """The 12 serving features of forecast date ``d``, in payload order; ``known`` ones are columns."""
    cal = serving_calendar(d)
    return {n: F.col(n) if n in known else cal[n] if n in cal else F.lit(SERVING_PLACEHOLDERS[n]).cast("double")
            for n in SERVING_FEATURES}


def serving_features(expanded: DataFrame, date_col: str = "forecast_date", known: tuple[str, ...] = ()) -> DataFrame:
    """The 12 serving features in payload order (placeholders where no history is used)."""
    return expanded.withColumns(serving_feature_columns(F.col(date_col), known))


def feature_row_text(cols=SERVING_FEATURES) -> Column:
    return F.concat_ws(",", *[F.col(c).cast("string") for c in cols])


def payload_csv(valid: DataFrame) -> DataFrame:
    """Per valid request: the feature rows for days 1..horizon joined by ``,`` and newlines.

    Built inside the request row with a higher-order function: no explode, no shuffle.
    """
    def row(i):
        cal = serving_calendar(F.date_add(F.col("date"), i))
        vals = [cal[n] if n in cal else F.lit(SERVING_PLACEHOLDERS[n]).cast("double") for n in SERVING_FEATURES]
        return F.concat_ws(",", *[x.cast("string") for x in vals])

    rows = F.transform(F.sequence(F.lit(1), F.col("horizon").cast("int")), row)
    return valid.select("request_id", F.array_join(rows, "\n").alias("payload"))


# ------------------------------------------------------------------ S9-S13

Scorer = Callable[[DataFrame], DataFrame]


@dataclass
class ExpressionScorer:
    """Scores each feature row with a column expression (a stand-in for a model)."""

    expr: Column

    def __call__(self, features: DataFrame) -> DataFrame:
        return features.withColumn("prediction", self.expr.cast("double"))


@dataclass
class FeatureExpressionScorer:
    """Scores each forecast day with a column function of that day's 12 serving features.

    Evaluated inside the request row (``transform`` over the horizon): no explode and no
    shuffle, unlike a row-based model.
    """

    fn: Callable[[dict], Column]

    def predictions(self) -> Column:
        def day(i):
            feats = serving_feature_columns(F.date_add(F.col("date"), i))
            return self.fn(feats).cast("double")

        return F.transform(F.sequence(F.lit(1), F.col("horizon").cast("int")), day)


@dataclass
class ModelScorer:
    """Scores with a fitted Spark ML ``PipelineModel`` that writes ``prediction``."""

    model: object

    def __call__(self, features: DataFrame) -> DataFrame:
        return self.model.transform(features)


# Fixed value: the text forms a Python ``float()`` takes (after stripping blanks).
_DIGITS = "[0-9](?:_?[0-9])*"
FLOAT_TEXT = rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?|nan)$"


def python_float(text: Column) -> Column:
    """Double of a text that is a Python float literal (``1_000``, ``nan``, ``1.``), else null
    (``1.5d`` and hexadecimal forms, which a bare cast would take)."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(t.rlike(FLOAT_TEXT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def parse_predictions(replies: DataFrame, text_col: str = "reply", key: str = "request_id", keep=()) -> DataFrame:
    """Reply text -> ``predictions`` array<double>: strip, split on newlines, cast each.
    A value that is not a number sets ``prediction_error`` (the request then fails with 500)."""
    stripped = F.regexp_replace(F.col(text_col), r"^\s+|\s+$", "")
    parts = F.split(stripped, "\n")
    # each part is parsed once; a part that fails is found by its place among the values
    parsed = replies.select(key, *keep, parts.alias("_parts"), F.transform(parts, python_float).alias("_values"))
    at = F.array_position(F.transform("_values", lambda v: v.isNull()), True)
    first_bad = F.when(at > 0, F.get("_parts", (at - 1).cast("int")))
    return parsed.select(
        key,
        *keep,
        F.col("_values").alias("predictions"),
        F.when(first_bad.isNotNull(), F.concat(F.lit(R.MSG_INFERENCE_FAILED + "could not convert string to float: '"),
                                                first_bad, F.lit("'"))).alias("prediction_error"),
    )


def zip_predictions(dates: Column, predictions: Column) -> Column:
    """Pair dates and predictions by position, truncated to the shorter list."""
    n = F.least(F.size(dates), F.size(predictions))
    zipped = F.arrays_zip(dates.alias("date"), predictions.alias("forecast"))
    return F.slice(zipped, 1, n)


REQUEST_COLS = ("request_id", "status", "error", "store_id", "item_id", "store_json", "item_json", "date", "horizon")


def score_days(validated: DataFrame, scorer: Scorer, known: tuple[str, ...] = (),
               day_features: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per request (valid or not): ``predictions`` array<double> in day order.

    ``known`` columns of the requests stay as they are; ``day_features`` adds the rest to the day rows (by
    default those of the 12 serving features that are not known).

    One pass: valid requests explode into their forecast days (``explode_outer`` keeps
    rejected requests as one row without a day), the scorer runs on the day rows, and
    one regroup by request collects the predictions. The request columns ride along in
    the grouping key (they depend on ``request_id`` only), so there is no join back.
    """
    valid = F.col("status").isNull()
    # A row id assigned before the explode keys the regroup: each group is one request
    # (at most 30 day rows) even when many requests share a request_id.
    keyed = validated.select(*REQUEST_COLS, *[F.col(f"`{c}`") for c in known], F.monotonically_increasing_id().alias("_row"))
    days = keyed.select(
        "*", F.explode_outer(F.when(valid, F.sequence(F.lit(1), F.col("horizon").cast("int")))).alias("day"),
    ).withColumn("forecast_date", F.date_add(F.col("date"), F.col("day")))
    scored = scorer(day_features(days) if day_features else serving_features(days, known=known))
    pair = F.when(F.col("day").isNotNull(), F.struct("day", F.col("prediction").cast("double").alias("p")))
    return scored.groupBy("_row", *REQUEST_COLS).agg(
        F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["p"]).alias("predictions")
    ).drop("_row").withColumn("prediction_error", F.lit(None).cast("string"))


def attach_replies(validated: DataFrame, replies: DataFrame, text_col: str = "reply") -> DataFrame:
    """Per request: predictions parsed from an external scorer's reply text (left join).

    Replies are first reduced to one row per request id (partial aggregation, so a hot id
    costs one row per task), which keeps the join one-to-one per reply: duplicate ids never
    multiply into pairs. An id with several replies is ambiguous and fails with 500.
    """
    one = replies.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_replies"), F.first(text_col).alias(text_col))
    parsed = parse_predictions(one, text_col, keep=("_replies",))
    parsed = parsed.select(
        "request_id",
        F.when(F.col("_replies") == 1, F.col("predictions")).alias("predictions"),
        F.when(F.col("_replies") > 1, F.lit(R.MSG_INFERENCE_FAILED + "more than one reply for this request"))
        .otherwise(F.col("prediction_error")).alias("prediction_error"),
    )
    return validated.select(*REQUEST_COLS).join(parsed, "request_id", "left")


def assemble_responses(scored: DataFrame) -> DataFrame:
    """Final status and body per request. Rejected requests keep their status; valid ones
    get 200 and ``predictions`` (dates paired by position, truncated to the shorter list),
    or 500 when their predictions are missing or could not be parsed."""
    valid = F.col("status").isNull()
    dates = F.transform(F.sequence(F.lit(1), F.col("horizon").cast("int")),
                        lambda i: F.date_format(F.date_add(F.col("date"), i), "yyyy-MM-dd"))
    failed = valid & (F.col("prediction_error").isNotNull() | F.col("predictions").isNull())
    pred_struct = F.transform(zip_predictions(dates, F.col("predictions")),
                              lambda x: F.struct(x["date"].alias("date"), x["forecast"].alias("forecast")))
    out = scored.select(
        "request_id",
        F.when(failed, R.STATUS_FAILED).when(valid, R.STATUS_OK).otherwise(F.col("status")).cast("int").alias("status"),
        F.when(failed, F.coalesce(F.col("prediction_error"), F.lit(R.MSG_INFERENCE_FAILED + "no prediction")))
        .otherwise(F.col("error")).alias("error"),
        "store_id", "item_id", "store_json", "item_json",
        F.when(valid & ~failed, pred_struct).alias("predictions"),
    )
    body = F.when(F.col("status") == R.STATUS_OK, R.predictions_body(F.col("store_json"), F.col("item_json"), F.col("predictions")))
    return out.withColumn("response_body", body.otherwise(R.error_body(F.col("error")))).drop("store_json", "item_json")


def score_in_row(validated: DataFrame, scorer) -> DataFrame:
    """Per request: predictions computed inside the row (narrow, no shuffle). ``scorer`` gives the array of the
    request's days as a column."""
    columns = [F.when(F.col("status").isNull(), scorer.predictions()).alias("predictions"), F.lit(None).cast("string").alias("prediction_error")]
    if getattr(scorer, "costly", False):
        # through a one-row generator, as the validated request: what follows then reads the predictions
        # instead of computing them again for every column made of them
        return validated.select(*REQUEST_COLS, F.inline(F.array(F.struct(*columns))))
    return validated.select(*REQUEST_COLS, *columns)


def score_requests(requests: DataFrame, scorer) -> DataFrame:
    """End to end: requests -> responses (status, error, store_id, item_id, predictions, body)."""
    validated = validate_requests(requests)
    if hasattr(scorer, "predictions"):  # scores a request's days within its row
        return assemble_responses(score_in_row(validated, scorer))
    return assemble_responses(score_days(validated, scorer))


def score_requests_with_replies(requests: DataFrame, replies: DataFrame, text_col: str = "reply") -> DataFrame:
    """End to end with an external scorer's newline-separated reply text per request."""
    return assemble_responses(attach_replies(validate_requests(requests), replies, text_col))
