"""DuckDB oracle SQL for the request-scoring queries (fixture built from ``orders``)."""

from __future__ import annotations

NL = "chr(10)"

REQUESTS = """
req AS (
  SELECT o_orderkey AS request_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'not json' ELSE
           '{"store_id":"' || CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE 'S' || CAST(o_custkey % 25 AS VARCHAR) END ||
           '","item_id":"' || CASE WHEN o_orderkey % 83 = 0 THEN '' ELSE 'P' || CAST(o_custkey % 50 AS VARCHAR) END ||
           '","date":"' || CASE WHEN o_orderkey % 79 = 0 THEN '15/01/2023' ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END ||
           '"' ||
           CASE WHEN o_orderkey % 7 = 0 THEN ''
                WHEN o_orderkey % 73 = 0 THEN ',"horizon":"abc"'
                ELSE ',"horizon":' || CAST(o_orderkey % 34 AS VARCHAR) END ||
           '}'
         END AS body
  FROM orders
)"""

_DATE_RE = "^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"

FIELDS = f"""
fields AS (
  SELECT request_id, ok, t,
         json_type(ob, '$.store_id') AS st, json_extract_string(ob, '$.store_id') AS store_s,
         json_extract(ob, '$.store_id') AS store_j,
         json_type(ob, '$.item_id') AS it, json_extract_string(ob, '$.item_id') AS item_s,
         json_extract(ob, '$.item_id') AS item_j,
         json_type(ob, '$.date') AS dt, json_extract_string(ob, '$.date') AS ds,
         json_type(ob, '$.horizon') AS ht, json_extract(ob, '$.horizon') AS hj
  FROM (SELECT request_id, ok, t, CASE WHEN t = 'OBJECT' THEN jb END AS ob
        FROM (SELECT request_id, ok, jb, json_type(jb) AS t
              FROM (SELECT request_id, COALESCE(json_valid(body), false) AS ok,
                           CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS jb FROM req)))
),
typed AS (
  SELECT *,
    CASE WHEN NOT ok OR t <> 'OBJECT' THEN NULL
         WHEN st IS NULL OR st = 'NULL' THEN false
         WHEN st = 'VARCHAR' THEN length(store_s) > 0
         ELSE true END AS store_ok,
    CASE WHEN NOT ok OR t <> 'OBJECT' THEN NULL
         WHEN it IS NULL OR it = 'NULL' THEN false
         WHEN it = 'VARCHAR' THEN length(item_s) > 0
         ELSE true END AS item_ok,
    CASE WHEN dt = 'VARCHAR' AND regexp_matches(ds, '{_DATE_RE}') AND regexp_extract(ds, '{_DATE_RE}', 1) <> '0000'
         THEN CAST(try_strptime(regexp_extract(ds, '{_DATE_RE}', 1) || '-' ||
                                lpad(regexp_extract(ds, '{_DATE_RE}', 2), 2, '0') || '-' ||
                                lpad(trim(regexp_extract(ds, '{_DATE_RE}', 3)), 2, '0'), '%Y-%m-%d') AS DATE)
    END AS date_v,
    CASE WHEN ht IS NULL THEN CAST(1 AS BIGINT)
         WHEN ht IN ('BIGINT', 'UBIGINT') THEN TRY_CAST(CAST(hj AS VARCHAR) AS BIGINT)
         WHEN ht = 'BOOLEAN' THEN CASE WHEN CAST(hj AS VARCHAR) = 'true' THEN 1 ELSE 0 END
    END AS h_v
  FROM fields
),
validated AS (
  SELECT request_id,
    CAST(CASE WHEN NOT ok THEN 400
         WHEN t <> 'OBJECT' THEN 500
         WHEN NOT store_ok THEN 400
         WHEN NOT item_ok THEN 400
         WHEN date_v IS NULL THEN 400
         WHEN h_v IS NULL OR h_v < 1 OR h_v > 30 THEN 400
         WHEN date_v + CAST(h_v AS INTEGER) > DATE '9999-12-31' THEN 500 END AS INTEGER) AS status,
    CASE WHEN NOT ok THEN 'Invalid request body'
         WHEN t <> 'OBJECT' THEN 'Inference failed: ''' ||
              CASE t WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool'
                     WHEN 'NULL' THEN 'NoneType' WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' ELSE 'float' END ||
              ''' object has no attribute ''get'''
         WHEN NOT store_ok THEN 'store_id is required'
         WHEN NOT item_ok THEN 'item_id is required'
         WHEN date_v IS NULL THEN 'date must be in YYYY-MM-DD format'
         WHEN h_v IS NULL OR h_v < 1 OR h_v > 30 THEN 'horizon must be an integer between 1 and 30'
         WHEN date_v + CAST(h_v AS INTEGER) > DATE '9999-12-31' THEN 'Inference failed: date value out of range' END AS error,
    CASE WHEN ok AND t = 'OBJECT' THEN CASE WHEN st = 'VARCHAR' THEN store_s ELSE CAST(store_j AS VARCHAR) END END AS store_id,
    CASE WHEN ok AND t = 'OBJECT' THEN CASE WHEN it = 'VARCHAR' THEN item_s ELSE CAST(item_j AS VARCHAR) END END AS item_id,
    CAST(store_j AS VARCHAR) AS store_json, CAST(item_j AS VARCHAR) AS item_json,
    CASE WHEN ok AND t = 'OBJECT' THEN date_v END AS "date",
    CASE WHEN ok AND t = 'OBJECT' AND h_v BETWEEN 1 AND 30 THEN h_v END AS horizon,
    (ht IS NULL) AS horizon_defaulted
  FROM typed
),
valid AS (SELECT * FROM validated WHERE status IS NULL),
days AS (
  SELECT v.*, g.day, CAST(v."date" + g.day * INTERVAL 1 DAY AS DATE) AS forecast_date
  FROM valid v, LATERAL (SELECT CAST(unnest(range(1, v.horizon + 1)) AS INTEGER) AS day) g
)"""

CAL = {
    "day_of_week": "CAST(isodow(forecast_date) - 1 AS DOUBLE)",
    "day_of_month": "CAST(dayofmonth(forecast_date) AS DOUBLE)",
    "month": "CAST(month(forecast_date) AS DOUBLE)",
    "year": "CAST(year(forecast_date) AS DOUBLE)",
    "is_weekend": "CAST(CASE WHEN isodow(forecast_date) - 1 >= 5 THEN 1 ELSE 0 END AS DOUBLE)",
}
FEATURES = {
    "store_id_encoded": "CAST(0 AS DOUBLE)", "item_id_encoded": "CAST(0 AS DOUBLE)",
    "day_of_week": CAL["day_of_week"], "day_of_month": CAL["day_of_month"], "month": CAL["month"],
    "year": CAL["year"], "is_weekend": CAL["is_weekend"],
    "lag_1_sales": "CAST(0 AS DOUBLE)", "lag_7_sales": "CAST(0 AS DOUBLE)", "rolling_mean_7": "CAST(0 AS DOUBLE)",
    "price": "CAST(50 AS DOUBLE)", "promo": "CAST(0 AS DOUBLE)",
}
STAND_IN = "(CAST(dayofmonth(forecast_date) AS DOUBLE) + month(forecast_date) / 100.0)"

# What Python's float() takes: digits with single underscores, a point, an exponent; inf and nan.
PY_FLOAT = (r"regexp_full_match(x, '[+-]?(([0-9](_?[0-9])*[.]?([0-9](_?[0-9])*)?|[.][0-9](_?[0-9])*)"
            r"([eE][+-]?[0-9](_?[0-9])*)?|(?i:inf|infinity|nan))')")

REPLIES = f"""
reply_vals AS (
  SELECT request_id, horizon, day,
         CASE WHEN request_id % 13 = 0 AND day = 1 THEN ['n/a', '1.5d', '0x1p3', '1_000', 'nan'][1 + (request_id // 13) % 5] ELSE CAST({STAND_IN} AS VARCHAR) END AS val
  FROM days
  WHERE NOT (request_id % 11 = 0 AND day = horizon)
),
replies AS (
  SELECT v.request_id,
         COALESCE((SELECT string_agg(val, {NL} ORDER BY day) FROM reply_vals r WHERE r.request_id = v.request_id), '')
           || {NL} AS reply
  FROM valid v
),
parsed AS (
  SELECT request_id, parts,
         list_transform(parts, lambda x: CASE WHEN {PY_FLOAT} THEN CAST(replace(x, '_', '') AS DOUBLE) END) AS preds,
         list_filter(parts, lambda x: NOT {PY_FLOAT}) AS bad
  FROM (SELECT request_id, string_split(trim(reply, ' ' || {NL} || chr(9) || chr(13)), {NL}) AS parts FROM replies)
),
pred_err AS (
  SELECT request_id, preds,
         CASE WHEN len(bad) > 0 THEN 'Inference failed: could not convert string to float: ''' || bad[1] || '''' END AS prediction_error
  FROM parsed
),
zipped AS (
  SELECT d.request_id, d.day, strftime(d.forecast_date, '%Y-%m-%d') AS "date", p.preds[d.day] AS forecast
  FROM days d JOIN pred_err p ON p.request_id = d.request_id
  WHERE p.prediction_error IS NULL AND d.day <= len(p.preds)
),
ok_resp AS (
  SELECT v.request_id,
         CAST(CASE WHEN p.prediction_error IS NULL THEN 200 ELSE 500 END AS INTEGER) AS status,
         p.prediction_error AS error, v.store_id, v.item_id,
         CASE WHEN p.prediction_error IS NULL THEN
           (SELECT CAST(COUNT(*) AS INTEGER) FROM zipped z WHERE z.request_id = v.request_id) END AS n_predictions,
         CASE WHEN p.prediction_error IS NULL THEN
           '{{"store_id": ' || v.store_json || ', "item_id": ' || v.item_json || ', "predictions": [' ||
           COALESCE((SELECT string_agg('{{"date": "' || z."date" || '", "forecast": ' || CASE WHEN isnan(z.forecast) THEN 'NaN' ELSE CAST(z.forecast AS VARCHAR) END || '}}', ', '
                                       ORDER BY z.day) FROM zipped z WHERE z.request_id = v.request_id), '') || ']}}'
         ELSE '{{"error": ' || to_json(p.prediction_error) || '}}' END AS response_body
  FROM valid v JOIN pred_err p ON p.request_id = v.request_id
),
responses AS (
  SELECT * FROM ok_resp
  UNION ALL
  SELECT request_id, status, error, store_id, item_id, CAST(NULL AS INTEGER) AS n_predictions,
         '{{"error": ' || to_json(error) || '}}' AS response_body
  FROM validated WHERE status IS NOT NULL
)"""

SCORED = f"""
scored_days AS (SELECT request_id, day, strftime(forecast_date, '%Y-%m-%d') AS "date", {STAND_IN} AS forecast FROM days),
scored AS (
  SELECT v.request_id, CAST(200 AS INTEGER) AS status, CAST(NULL AS VARCHAR) AS error, v.store_id, v.item_id,
         CAST(v.horizon AS INTEGER) AS n_predictions,
         '{{"store_id": ' || v.store_json || ', "item_id": ' || v.item_json || ', "predictions": [' ||
         (SELECT string_agg('{{"date": "' || s."date" || '", "forecast": ' || CAST(s.forecast AS VARCHAR) || '}}', ', '
                            ORDER BY s.day) FROM scored_days s WHERE s.request_id = v.request_id) || ']}}' AS response_body
  FROM valid v
  UNION ALL
  SELECT request_id, status, error, store_id, item_id, CAST(NULL AS INTEGER), '{{"error": ' || to_json(error) || '}}'
  FROM validated WHERE status IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (REQUESTS, FIELDS)

REQUEST_ORACLE = {
    "parse_requests": _with(*BASE) + """
SELECT request_id,
       CAST(CASE WHEN NOT ok THEN 400 WHEN t <> 'OBJECT' THEN 500 END AS INTEGER) AS parse_status,
       CASE WHEN NOT ok THEN 'Invalid request body'
            WHEN t <> 'OBJECT' THEN 'Inference failed: ''' ||
              CASE t WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool'
                     WHEN 'NULL' THEN 'NoneType' WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' ELSE 'float' END ||
              ''' object has no attribute ''get''' END AS parse_error
FROM typed""",
    "validate_requests": _with(*BASE) + 'SELECT request_id, status, error, store_id, item_id, "date", horizon, horizon_defaulted FROM validated',
    "default_horizon": _with(*BASE) + "SELECT request_id, horizon FROM valid WHERE horizon_defaulted",
    "rejected_requests": _with(*BASE) + "SELECT request_id, status, error FROM validated WHERE status IS NOT NULL",
    "horizon_expand": _with(*BASE) + "SELECT request_id, day, forecast_date FROM days",
    "serving_calendar": _with(*BASE) + "SELECT request_id, day, " + ", ".join(f"{v} AS {k}" for k, v in CAL.items()) + " FROM days",
    "serving_features": _with(*BASE) + "SELECT request_id, day, " + ", ".join(f"{v} AS {k}" for k, v in FEATURES.items()) + " FROM days",
    "payload_csv": _with(*BASE) + f"""
SELECT request_id, string_agg(row_text, {NL} ORDER BY day) AS payload
FROM (SELECT request_id, day, concat_ws(',', """ + ", ".join(f"CAST({v} AS VARCHAR)" for v in FEATURES.values()) + """) AS row_text FROM days)
GROUP BY request_id""",
    "parse_predictions": _with(*BASE, REPLIES) + """
SELECT p.request_id, p.prediction_error, CAST(u.pos - 1 AS INTEGER) AS pos, u.forecast
FROM pred_err p, LATERAL (SELECT generate_subscripts(p.preds, 1) AS pos, unnest(p.preds) AS forecast) u""",
    "zip_predictions": _with(*BASE, REPLIES) + 'SELECT request_id, "date", forecast FROM zipped',
    "responses": _with(*BASE, REPLIES) + "SELECT * FROM responses",
    "scored_responses": _with(*BASE, SCORED) + "SELECT * FROM scored",
    # what SQL can state of a trained model's responses: status, error, and how many days from when to when
    "model_scored_responses": _with(*BASE) + """
SELECT request_id, CAST(COALESCE(status, 200) AS INTEGER) AS status, error,
       CASE WHEN status IS NULL THEN CAST(horizon AS INTEGER) END AS n_predictions,
       CASE WHEN status IS NULL THEN strftime("date" + INTERVAL 1 DAY, '%Y-%m-%d') END AS first_date,
       CASE WHEN status IS NULL THEN strftime("date" + CAST(horizon AS INTEGER) * INTERVAL 1 DAY, '%Y-%m-%d') END AS last_date,
       CASE WHEN status IS NULL THEN TRUE END AS all_finite
FROM validated""",
    "scored_responses_by_row": _with(*BASE, SCORED) + "SELECT * FROM scored",
}
