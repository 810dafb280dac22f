"""DuckDB oracle SQL for the history-based serving features (an as-of join per request)."""

from __future__ import annotations

from oracle.sql import CATS, COMPLETED, LABELS, LAGS, NUMS, OUTPUT, PRICE_SQL, SPLITS, WINDOWS, _mode_subquery, calendar_sql, encoded_cte, qi, with_

HISTORY = """
hist AS (
  SELECT "Store ID" AS s, "Product ID" AS p, "Date" AS d, "Demand" AS lag_1_sales, lag("Demand", 6) OVER w AS lag_7_sales,
         avg("Demand") OVER (PARTITION BY "Store ID", "Product ID" ORDER BY "Date" NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean_7,
         "Price" AS price, "Promotion" AS promo
  FROM panel_imputed WINDOW w AS (PARTITION BY "Store ID", "Product ID" ORDER BY "Date" NULLS FIRST)),
asked AS (
  SELECT CAST(o_orderkey AS BIGINT) AS request_id, CASE WHEN o_orderkey % 11 = 0 THEN 'NOWHERE' ELSE n_name END AS s,
         'Brand#' || CAST(1 + o_orderkey % 5 AS VARCHAR) || CAST(1 + (o_orderkey // 5) % 5 AS VARCHAR) AS p,
         CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 7 AS INTEGER) AS h
  FROM orders JOIN nation ON o_custkey % 25 = n_nationkey),
known AS (
  SELECT a.request_id, a.d, a.h,
         CAST(COALESCE(ls."index", (SELECT n FROM label_sizes WHERE "column" = 'Store ID'), 0) AS DOUBLE) AS store_id_encoded,
         CAST(COALESCE(li."index", (SELECT n FROM label_sizes WHERE "column" = 'Product ID'), 0) AS DOUBLE) AS item_id_encoded,
         CAST(COALESCE(x.lag_1_sales, 0) AS DOUBLE) AS lag_1_sales, CAST(COALESCE(x.lag_7_sales, 0) AS DOUBLE) AS lag_7_sales,
         CAST(COALESCE(x.rolling_mean_7, 0) AS DOUBLE) AS rolling_mean_7, CAST(COALESCE(x.price, 50) AS DOUBLE) AS price,
         CAST(COALESCE(x.promo, 0) AS DOUBLE) AS promo
  FROM asked a ASOF LEFT JOIN hist x ON a.s = x.s AND a.p = x.p AND a.d > x.d
  LEFT JOIN labels ls ON ls."column" = 'Store ID' AND ls.value = a.s
  LEFT JOIN labels li ON li."column" = 'Product ID' AND li.value = a.p)"""

# the whole matrix row of each forecast day: the series' last row before the request, or the fitted fills
_OWN = 'PARTITION BY "Store ID", "Product ID" ORDER BY "Date" NULLS FIRST'
_LAGGED = {f"demand_lag_{k}": f'lag("Demand", {k - 1}) OVER ({_OWN})' for k in LAGS}
for _n in WINDOWS:
    _LAGGED[f"demand_roll_mean_{_n}"] = f'avg("Demand") OVER ({_OWN} ROWS BETWEEN {_n - 1} PRECEDING AND CURRENT ROW)'
    _LAGGED[f"demand_roll_std_{_n}"] = f'stddev_samp("Demand") OVER ({_OWN} ROWS BETWEEN {_n - 1} PRECEDING AND CURRENT ROW)'
_OTHERS = [c for c in CATS if c not in ("Store ID", "Product ID")]
MATRIX_DAYS = f"""
whole AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in _LAGGED.items())} FROM panel_imputed),
held AS (
  SELECT a.request_id, a.d AS asked, a.h, a.s AS "Store ID", a.p AS "Product ID",
         {", ".join(f"COALESCE(x.{qi(c)}, {_mode_subquery(c)}) AS {qi(c)}" for c in _OTHERS)},
         {", ".join(f"COALESCE(x.{qi(c)}, med.{qi(c)}) AS {qi(c)}" for c in NUMS)},
         {", ".join(f"CAST(COALESCE(x.{k}, 0) AS DOUBLE) AS {k}" for k in _LAGGED)}
  FROM asked a ASOF LEFT JOIN whole x ON a.s = x."Store ID" AND a.p = x."Product ID" AND a.d > x."Date", med
  WHERE a.h >= 1),
days AS (
  SELECT * EXCLUDE (asked, h), CAST(asked + CAST(day AS INTEGER) * INTERVAL 1 DAY AS DATE) AS "Date"
  FROM (SELECT *, CAST(unnest(range(1, h + 1)) AS INTEGER) AS day FROM held)),
dated AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in (PRICE_SQL | calendar_sql()).items())} FROM days)"""

_NAMES = ("store_id_encoded", "item_id_encoded", "lag_1_sales", "lag_7_sales", "rolling_mean_7", "price", "promo")
_BASE = with_(*COMPLETED, SPLITS, LABELS, HISTORY)

HISTORY_ORACLE = {
    "history_matrix_rows": with_(*COMPLETED, SPLITS, LABELS, HISTORY, MATRIX_DAYS, encoded_cte("dated", "enc")) + "SELECT request_id, day, "
    + ", ".join(f"round({c}, 6) AS {c}" if "std" in c else qi(c) for c in OUTPUT[1:]) + " FROM enc",
    "history_lookup": _BASE + "SELECT request_id, CASE WHEN h < 1 THEN CAST(400 AS INTEGER) END AS status, "
    + ", ".join(f"CASE WHEN h >= 1 THEN {n} END AS {n}" for n in _NAMES) + " FROM known",
    "history_model_responses": _BASE + """
SELECT request_id, CAST(CASE WHEN h < 1 THEN 400 ELSE 200 END AS INTEGER) AS status, CASE WHEN h >= 1 THEN h END AS n_predictions,
       CASE WHEN h >= 1 THEN TRUE END AS agree FROM known""",
    "history_scored_responses": _BASE + """
SELECT request_id, CAST(200 AS INTEGER) AS status, strftime(f, '%Y-%m-%d') AS "date",
       round(rolling_mean_7 + lag_1_sales * 100 + dayofmonth(f) / 64.0 + store_id_encoded, 6) AS forecast
FROM (SELECT *, CAST(d + CAST(unnest(range(1, h + 1)) AS INTEGER) * INTERVAL 1 DAY AS DATE) AS f FROM known WHERE h >= 1)
UNION ALL SELECT request_id, CAST(400 AS INTEGER), NULL, NULL FROM known WHERE h < 1""",
}
