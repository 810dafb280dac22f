"""Independent DuckDB SQL for every checkable query (tables are pre-registered views).

Written from the operator semantics, not from the Spark code: plain GROUP BY, window
functions and scalar subqueries. DuckDB defaults differ from Spark in a few places, so
they are pinned explicitly: NULLS FIRST in window order, ``isodow - 1`` for Monday=0,
casts for integer widths, NaN treated as missing in ``dropna``.
"""

from __future__ import annotations

# Fixed values shared with the library (names and order of the panel).
CATS = ["Store ID", "Product ID", "Category", "Region", "Weather Condition", "Seasonality"]
NUMS = ["Inventory Level", "Price", "Discount", "Promotion", "Competitor Pricing", "Epidemic"]
TARGET = "Demand"
TYPED_NUMS = NUMS + [TARGET]
LAGS = [1, 7, 14, 28]
WINDOWS = [7, 30]
CALENDAR = ["day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year", "is_weekend"]
ENGINEERED = (
    ["price_vs_competitor", "discount_pct"] + CALENDAR + [f"demand_lag_{k}" for k in LAGS]
    + [x for n in WINDOWS for x in (f"demand_roll_mean_{n}", f"demand_roll_std_{n}")]
)
OUTPUT = [TARGET] + CATS + NUMS + ENGINEERED
CUTOFF = "2000-01-01"


def qi(name: str) -> str:
    return '"' + name + '"'


def _fixed_text(units: str, scale: int) -> str:
    base = 10**scale
    return f"CAST({units} // {base} AS VARCHAR) || '.' || lpad(CAST({units} % {base} AS VARCHAR), {scale}, '0')"


PANEL_GROUPS = """
pg AS (
  SELECT na.n_nationkey, na.n_name, pa.p_brand, CAST(li.l_shipdate AS DATE) AS d,
         SUM(CAST(li.l_quantity AS BIGINT)) AS q,
         COUNT(*) AS n,
         SUM(CAST(li.l_linenumber AS BIGINT)) AS ln,
         SUM(CAST(ROUND(li.l_extendedprice * 100) AS BIGINT)) AS ep_c,
         SUM(CAST(ROUND(li.l_discount * 100) AS BIGINT)) AS disc_c,
         MAX(CAST(ROUND(li.l_discount * 100) AS BIGINT)) AS disc_max,
         SUM(CAST(ROUND(pa.p_retailprice * 100) AS BIGINT)) AS rp_c,
         MIN(pa.p_type) AS ptype,
         MIN(re.r_name) AS rname
  FROM lineitem li
  JOIN part pa ON li.l_partkey = pa.p_partkey
  JOIN supplier su ON li.l_suppkey = su.s_suppkey
  JOIN nation na ON su.s_nationkey = na.n_nationkey
  JOIN region re ON na.n_regionkey = re.r_regionkey
  GROUP BY 1, 2, 3, 4
),
pk AS (
  SELECT *, dayofyear(d) + n_nationkey AS k,
         (2 * ep_c + q) // (2 * q) AS price_c,
         (2 * disc_c * 100 + n) // (2 * n) AS disc_bp,
         (2 * rp_c + n) // (2 * n) AS comp_c
  FROM pg
)"""

_WEATHER = "CASE k % 4 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Rainy' WHEN 2 THEN 'Cloudy' ELSE 'Snowy' END"
_SEASON = ("CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring' "
           "WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")

PANEL_RAW = f"""
panel_raw AS (
  SELECT strftime(d, '%Y-%m-%d') AS "Date",
         n_name AS "Store ID",
         p_brand AS "Product ID",
         CASE WHEN k % 41 <> 0 THEN ptype END AS "Category",
         CASE WHEN k % 43 <> 0 THEN rname END AS "Region",
         CASE WHEN k % 59 = 0 THEN 'n/a' ELSE CAST(ln * 10 AS VARCHAR) END AS "Inventory Level",
         CAST(q AS VARCHAR) AS "Units Sold",
         CAST(n AS VARCHAR) AS "Units Ordered",
         CASE WHEN k % 37 <> 0 THEN {_fixed_text('price_c', 2)} END AS "Price",
         {_fixed_text('disc_bp', 4)} AS "Discount",
         {_WEATHER} AS "Weather Condition",
         CASE WHEN disc_max >= 9 THEN '1' ELSE '0' END AS "Promotion",
         {_fixed_text('comp_c', 2)} AS "Competitor Pricing",
         {_SEASON} AS "Seasonality",
         CASE WHEN year(d) = 1998 THEN '1' ELSE '0' END AS "Epidemic",
         CASE WHEN k % 53 <> 0 THEN CAST(q AS VARCHAR) END AS "Demand",
         CASE WHEN k % 97 = 0 THEN 'not-a-date' ELSE strftime(d, '%Y-%m-%d') END AS "Date_bad"
  FROM pk
)"""

PANEL_TYPED_FIXTURE = f"""
panel_fixture AS (
  SELECT d AS "Date",
         n_name AS "Store ID",
         p_brand AS "Product ID",
         CASE WHEN k % 41 <> 0 THEN ptype END AS "Category",
         CASE WHEN k % 43 <> 0 THEN rname END AS "Region",
         CAST(ln * 10 AS DOUBLE) AS "Inventory Level",
         CAST(q AS DOUBLE) AS "Units Sold",
         CAST(n AS DOUBLE) AS "Units Ordered",
         CASE WHEN k % 37 <> 0 THEN price_c / 100.0 END AS "Price",
         disc_bp / 10000.0 AS "Discount",
         {_WEATHER} AS "Weather Condition",
         CAST(CASE WHEN disc_max >= 9 THEN 1 ELSE 0 END AS DOUBLE) AS "Promotion",
         comp_c / 100.0 AS "Competitor Pricing",
         {_SEASON} AS "Seasonality",
         CAST(CASE WHEN year(d) = 1998 THEN 1 ELSE 0 END AS DOUBLE) AS "Epidemic",
         CASE WHEN k % 53 <> 0 THEN CAST(q AS DOUBLE) END AS "Demand"
  FROM pk
)"""

PANEL_TYPED = """
panel_typed AS (
  SELECT CAST(TRY_STRPTIME("Date", '%Y-%m-%d') AS DATE) AS "Date",
         "Store ID", "Product ID", "Category", "Region", "Weather Condition", "Seasonality",
         """ + ",\n         ".join(f"TRY_CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in TYPED_NUMS) + """
  FROM panel_raw
)"""

MEDIANS = """
med AS (
  SELECT """ + ",\n         ".join(
    f"COALESCE(quantile_disc({qi(c)}, 0.5) FILTER (WHERE NOT isnan({qi(c)})), 0.0) AS {qi(c)}" for c in TYPED_NUMS
) + """
  FROM panel_typed
)"""


def _mode_subquery(c: str, src: str = "panel_typed") -> str:
    return (f"COALESCE((SELECT {qi(c)} FROM {src} WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)} "
            f"ORDER BY COUNT(*) DESC, {qi(c)} ASC LIMIT 1), 'UNKNOWN')")


PANEL_IMPUTED = """
panel_imputed AS (
  SELECT t."Date",
         """ + ",\n         ".join(f"COALESCE(t.{qi(c)}, {_mode_subquery(c)}) AS {qi(c)}" for c in CATS) + """,
         """ + ",\n         ".join(f"COALESCE(t.{qi(c)}, med.{qi(c)}) AS {qi(c)}" for c in TYPED_NUMS) + """
  FROM panel_typed t, med
)"""


def _dow(week_start: str) -> str:
    return 'isodow("Date") - 1' if week_start == "monday0" else 'dayofweek("Date")'


def calendar_sql(week_start: str = "monday0") -> dict[str, str]:
    dow = _dow(week_start)
    return {
        "day_of_week": f"CAST({dow} AS INTEGER)",
        "day_of_month": 'CAST(dayofmonth("Date") AS INTEGER)',
        "week_of_year": 'CAST(weekofyear("Date") AS INTEGER)',
        "month": 'CAST(month("Date") AS INTEGER)',
        "quarter": 'CAST(quarter("Date") AS INTEGER)',
        "year": 'CAST(year("Date") AS INTEGER)',
        "is_weekend": f"CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END",
    }


PRICE_SQL = {
    "price_vs_competitor": '"Price" - "Competitor Pricing"',
    "discount_pct": '"Discount" / ("Price" + CAST(1e-6 AS DOUBLE))',
}
WIN = 'PARTITION BY "Store ID", "Product ID" ORDER BY "Date" ASC NULLS FIRST'
LAG_SQL = {f"demand_lag_{k}": f'CAST(lag("Demand", {k}) OVER ({WIN}) AS DOUBLE)' for k in LAGS}
ROLL_MEAN_SQL = {f"demand_roll_mean_{n}": f'avg("Demand") OVER ({WIN} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)'
                 for n in WINDOWS}
ROLL_STD_SQL = {f"demand_roll_std_{n}": f'round(stddev_samp("Demand") OVER ({WIN} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6)'
                for n in WINDOWS}
ROLL_STD_RAW = {f"demand_roll_std_{n}": f'stddev_samp("Demand") OVER ({WIN} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)'
                for n in WINDOWS}


def feature_sql(week_start: str = "monday0") -> dict[str, str]:
    d = {}
    d.update(PRICE_SQL)
    d.update(calendar_sql(week_start))
    d.update(LAG_SQL)
    for n in WINDOWS:
        d[f"demand_roll_mean_{n}"] = ROLL_MEAN_SQL[f"demand_roll_mean_{n}"]
        d[f"demand_roll_std_{n}"] = ROLL_STD_RAW[f"demand_roll_std_{n}"]
    return {k: d[k] for k in ENGINEERED}


def features_cte(week_start: str = "monday0", src: str = "panel_imputed", name: str = "feat") -> str:
    cols = feature_sql(week_start)
    return f"""
{name} AS (
  SELECT *, """ + ",\n         ".join(f"{expr} AS {k}" for k, expr in cols.items()) + f"""
  FROM {src}
)"""


DOUBLE_COLS = set(TYPED_NUMS) | {"price_vs_competitor", "discount_pct"} | set(LAG_SQL) | set(ROLL_MEAN_SQL) | set(ROLL_STD_SQL)


def _present(c: str) -> str:
    if c in DOUBLE_COLS:
        return f"({qi(c)} IS NOT NULL AND NOT isnan({qi(c)}))"
    return f"{qi(c)} IS NOT NULL"


REQUIRED = CATS + NUMS + ENGINEERED + [TARGET]
COMPLETE = """
complete AS (
  SELECT * FROM feat WHERE """ + "\n    AND ".join(_present(c) for c in REQUIRED) + """
)"""

SPLITS = f"""
train AS (SELECT * FROM complete WHERE "Date" < DATE '{CUTOFF}'),
val AS (SELECT * FROM complete WHERE "Date" >= DATE '{CUTOFF}')"""

LABELS = """
label_counts AS (
  """ + "\n  UNION ALL\n  ".join(
    f"SELECT '{c}' AS name, {qi(c)} AS value, COUNT(*) AS cnt FROM train WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)}"
    for c in CATS
) + """
),
labels AS (
  SELECT name AS "column", value, CAST(cnt AS BIGINT) AS "count",
         CAST(row_number() OVER (PARTITION BY name ORDER BY cnt DESC, value ASC) - 1 AS BIGINT) AS "index"
  FROM label_counts
),
label_sizes AS (SELECT "column", COUNT(*) AS n FROM labels GROUP BY "column")"""


def encoded_cte(src: str, name: str, unseen: str = "index") -> str:
    joins = []
    sel = []
    for i, c in enumerate(CATS):
        how = "LEFT JOIN" if unseen == "index" else "JOIN"
        joins.append(f'{how} labels l{i} ON l{i}."column" = \'{c}\' AND l{i}.value = s.{qi(c)}')
        sel.append(f'CAST(COALESCE(l{i}."index", (SELECT n FROM label_sizes WHERE "column" = \'{c}\'), 0) AS DOUBLE) AS {qi(c)}')
    excl = ", ".join(qi(c) for c in CATS)
    return f"""
{name} AS (
  SELECT s.* EXCLUDE ({excl}),
         """ + ",\n         ".join(sel) + f"""
  FROM {src} s
  """ + "\n  ".join(joins) + """
)"""


def rounded_select(cols, src: str) -> str:
    out = []
    for c in cols:
        if c.startswith("demand_roll_std_"):
            out.append(f"round({qi(c)}, 6) AS {qi(c)}")
        else:
            out.append(qi(c))
    return f"SELECT {', '.join(out)} FROM {src}"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (PANEL_GROUPS, PANEL_RAW, PANEL_TYPED)
IMPUTED = BASE + (MEDIANS, PANEL_IMPUTED)
FEATURED = IMPUTED + (features_cte(),)
COMPLETED = FEATURED + (COMPLETE,)
ENCODED = COMPLETED + (SPLITS, LABELS, encoded_cte("train", "enc_train"), encoded_cte("val", "enc_val"))
ENCODED_DROP = COMPLETED + (SPLITS, LABELS, encoded_cte("val", "enc_val_drop", unseen="drop"))

KEYS_SQL = '"Store ID", "Product ID", "Date"'
TYPED_COLS = ["Date"] + CATS + TYPED_NUMS
FEAT_COLS = TYPED_COLS + ENGINEERED
RAW_COLS_NO_LEAK = ["Date", "Store ID", "Product ID", "Category", "Region", "Inventory Level", "Price", "Discount",
                    "Weather Condition", "Promotion", "Competitor Pricing", "Seasonality", "Epidemic", "Demand"]


def _sel(cols) -> str:
    return ", ".join(qi(c) for c in cols)


ORACLE = {
    "demand_panel": with_(PANEL_GROUPS, PANEL_TYPED_FIXTURE) + "SELECT * FROM panel_fixture",
    "drop_leaky": with_(PANEL_GROUPS, PANEL_RAW) + f"SELECT {_sel(RAW_COLS_NO_LEAK)} FROM panel_raw",
    "cast_numeric": with_(PANEL_GROUPS, PANEL_RAW) + "SELECT " + ", ".join(
        (f"TRY_CAST({qi(c)} AS DOUBLE) AS {qi(c)}" if c in TYPED_NUMS else qi(c)) for c in RAW_COLS_NO_LEAK
    ) + " FROM panel_raw",
    "parse_date": with_(PANEL_GROUPS, PANEL_RAW)
    + 'SELECT "Store ID", "Product ID", "Date", CAST(TRY_STRPTIME("Date_bad", \'%Y-%m-%d\') AS DATE) AS "Date_bad" FROM panel_raw',
    "assemble_output": with_(*COMPLETED) + rounded_select(OUTPUT, "complete"),
    "row_metrics": with_(*ENCODED) + "SELECT " + ", ".join(
        f"(SELECT CAST(COUNT(*) AS BIGINT) FROM {src}) AS {name}" for name, src in (
            ("rows_raw", "panel_raw"), ("rows_imputed", "panel_imputed"), ("rows_before_drop", "feat"), ("rows_after_drop", "complete"),
            ("train_rows", "train"), ("validation_rows", "val"), ("train_rows_encoded", "enc_train"), ("validation_rows_encoded", "enc_val"))),
    "median_exact": with_(*BASE, MEDIANS) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(med.{qi(c)} AS DOUBLE) AS median FROM med" for c in TYPED_NUMS
    ),
    "median_approx": with_(*BASE) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(COUNT(*) AS BIGINT) AS n_values, TRUE AS within FROM panel_typed "
        f"WHERE {qi(c)} IS NOT NULL AND NOT isnan({qi(c)})" for c in TYPED_NUMS
    ),
    "panel_round_trip": with_(PANEL_GROUPS, PANEL_RAW) + 'SELECT * EXCLUDE ("Date_bad") FROM panel_raw',
    "matrix_round_trip": with_(*ENCODED) + "SELECT " + ", ".join(f"CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in OUTPUT)
    + " FROM (" + rounded_select(OUTPUT, "enc_train") + ")",
    "arrival_matrix": with_(*ENCODED) + rounded_select(OUTPUT, "enc_train"),
    "late_arrival_matrix": with_(*ENCODED) + rounded_select(OUTPUT, "enc_train"),
    "sorted_export": with_(*COMPLETED, SPLITS) + 'SELECT "Date", CAST(COUNT(*) AS BIGINT) AS n_rows, TRUE AS in_order, TRUE AS same_rows FROM train GROUP BY "Date"',
    "lags_with_ties": """
WITH li AS (
  SELECT CAST(l.l_shipdate AS DATE) AS "Date", na.n_name AS "Store ID", pa.p_brand AS "Product ID",
         CAST(l.l_quantity AS DOUBLE) AS "Demand", CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) / 100.0 AS "Price",
         CAST(0.0 AS DOUBLE) AS "Discount", CAST(1.0 AS DOUBLE) AS "Competitor Pricing",
         CAST(l.l_orderkey AS BIGINT) AS order_key, CAST(l.l_linenumber AS BIGINT) AS line
  FROM lineitem l JOIN part pa ON l.l_partkey = pa.p_partkey JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation na ON su.s_nationkey = na.n_nationkey)
SELECT *, """ + ", ".join(f'lag("Demand", {k}) OVER w AS demand_lag_{k}' for k in LAGS) + """,
       avg("Demand") OVER (PARTITION BY "Store ID", "Product ID" ORDER BY "Date", "Demand", "Price", "Discount", "Competitor Pricing",
                           order_key, line ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS demand_roll_mean_7
FROM li
WINDOW w AS (PARTITION BY "Store ID", "Product ID" ORDER BY "Date", "Demand", "Price", "Discount", "Competitor Pricing", order_key, line)""",
    "model_rmse": with_(*ENCODED) + """SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM enc_train) AS train_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM enc_val) AS validation_rows, TRUE AS beats_naive, TRUE AS reload_agrees""",
    "modes": with_(*BASE) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {_mode_subquery(c)} AS mode" for c in CATS
    ),
    "value_counts": with_(*BASE) + 'SELECT "Category", CAST(COUNT(*) AS BIGINT) AS "count" FROM panel_typed GROUP BY "Category"',
    "fill_numeric": with_(*BASE, MEDIANS) + "SELECT t.\"Date\", " + ", ".join(f"t.{qi(c)}" for c in CATS) + ", "
    + ", ".join(f"COALESCE(t.{qi(c)}, med.{qi(c)}) AS {qi(c)}" for c in TYPED_NUMS) + " FROM panel_typed t, med",
    "fill_categorical": with_(*BASE) + "SELECT t.\"Date\", "
    + ", ".join(f"COALESCE(t.{qi(c)}, {_mode_subquery(c)}) AS {qi(c)}" for c in CATS) + ", "
    + ", ".join(f"t.{qi(c)}" for c in TYPED_NUMS) + " FROM panel_typed t",
    "impute_missing": with_(*IMPUTED) + "SELECT * FROM panel_imputed",
    "dow_monday0": with_(*IMPUTED) + f"SELECT {KEYS_SQL}, " + calendar_sql("monday0")["day_of_week"] + " AS day_of_week, "
    + calendar_sql("monday0")["is_weekend"] + " AS is_weekend FROM panel_imputed",
    "dow_sunday0": with_(*IMPUTED) + f"SELECT {KEYS_SQL}, " + calendar_sql("sunday0")["day_of_week"] + " AS day_of_week, "
    + calendar_sql("sunday0")["is_weekend"] + " AS is_weekend FROM panel_imputed",
    "calendar_parts": with_(*IMPUTED) + f"SELECT {KEYS_SQL}, " + ", ".join(
        f"{calendar_sql()[k]} AS {k}" for k in ["day_of_month", "week_of_year", "month", "quarter", "year"]
    ) + " FROM panel_imputed",
    "price_features": with_(*BASE) + f"SELECT {KEYS_SQL}, " + ", ".join(f"{v} AS {k}" for k, v in PRICE_SQL.items())
    + " FROM panel_typed",
    "demand_lags": with_(*BASE) + f"SELECT {KEYS_SQL}, " + ", ".join(f"{v} AS {k}" for k, v in LAG_SQL.items())
    + " FROM panel_typed",
    "rolling_mean": with_(*BASE) + f"SELECT {KEYS_SQL}, " + ", ".join(f"{v} AS {k}" for k, v in ROLL_MEAN_SQL.items())
    + " FROM panel_typed",
    "rolling_std": with_(*BASE) + f"SELECT {KEYS_SQL}, " + ", ".join(f"{v} AS {k}" for k, v in ROLL_STD_SQL.items())
    + " FROM panel_typed",
    "engineer_features": with_(*FEATURED) + rounded_select(FEAT_COLS, "feat"),
    "engineer_features_sunday0": with_(*IMPUTED, features_cte("sunday0")) + rounded_select(FEAT_COLS, "feat"),
    "drop_incomplete": with_(*COMPLETED) + rounded_select(FEAT_COLS, "complete"),
    "split_train": with_(*COMPLETED, SPLITS) + rounded_select(FEAT_COLS, "train"),
    "split_validation": with_(*COMPLETED, SPLITS) + rounded_select(FEAT_COLS, "val"),
    "label_map": with_(*COMPLETED, SPLITS, LABELS) + "SELECT * FROM labels",
    "encode_train": with_(*ENCODED) + rounded_select(FEAT_COLS, "enc_train"),
    "encode_validation": with_(*ENCODED) + rounded_select(FEAT_COLS, "enc_val"),
    "encode_validation_drop": with_(*ENCODED_DROP) + rounded_select(FEAT_COLS, "enc_val_drop"),
    "rmse_baseline": with_(*ENCODED) + 'SELECT sqrt(avg(("Demand" - demand_lag_7) * ("Demand" - demand_lag_7))) AS rmse_baseline FROM enc_val WHERE demand_lag_7 IS NOT NULL',
    "training_matrix": with_(*ENCODED) + rounded_select(OUTPUT, "enc_train"),
    "validation_matrix": with_(*ENCODED) + rounded_select(OUTPUT, "enc_val"),
}
