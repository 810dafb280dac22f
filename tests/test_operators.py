"""Unit tests on hand-made frames: one per semantic trap of the pipeline."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import stats
from shelfcast.operators.encode import apply_labels, drop_unseen, fit_labels
from shelfcast.operators.features import engineer_features
from shelfcast.operators.impute import apply_imputer, fit_imputer, impute_missing
from shelfcast.operators.shaping import assemble_output, cast_numeric, drop_leaky, parse_date, prepare_raw
from shelfcast.operators.split import drop_incomplete, split_train, split_validation
from shelfcast.sources.panel import RAW_SCHEMA
from shelfcast.session import reliable_checkpoint
from shelfcast.spec import RAW_COLUMN_ORDER, RETAIL

BASE = dt.date(2021, 3, 1)


def raw_rows(n_days=40, stores=("North Pier",), products=("kettle",), start=BASE, demand=lambda i: 10 + i, **over):
    """A panel by rules of our own: stock falls by 3 a day, pairs of days share a category, each week
    two days are coastal, and all else stays the same."""
    rows = []
    for s in stores:
        for p in products:
            for i in range(n_days):
                d = start + dt.timedelta(days=i)
                r = {
                    "Date": d.isoformat(), "Store ID": s, "Product ID": p,
                    "Category": "Home" if i % 4 < 2 else "Garden", "Region": "Coast" if i % 7 < 2 else "Inland",
                    "Inventory Level": str(500 - 3 * i), "Units Sold": "6", "Units Ordered": "9",
                    "Price": "8.00", "Discount": "0.60", "Weather Condition": "Windy", "Promotion": "1",
                    "Competitor Pricing": "6.75", "Seasonality": "Dry", "Epidemic": "0",
                    "Demand": None if demand(i) is None else str(demand(i)),
                }
                for k, fn in over.items():
                    r[k.replace("_", " ")] = fn(s, p, i, r)
                rows.append(tuple(r[c] for c in RAW_COLUMN_ORDER))
    return rows


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


# ---------------------------------------------------------------- shaping

def test_drop_leaky_and_target_kept(spark):
    df = drop_leaky(raw_df(spark, raw_rows(3)))
    assert "Units Sold" not in df.columns and "Units Ordered" not in df.columns
    assert "Demand" in df.columns
    # absent names are ignored
    assert drop_leaky(df).columns == df.columns


def test_cast_numeric_malformed_and_nan(spark):
    rows = raw_rows(3)
    rows[0] = tuple("n/a" if c == "Price" else v for c, v in zip(RAW_COLUMN_ORDER, rows[0]))
    rows[1] = tuple("NaN" if c == "Price" else v for c, v in zip(RAW_COLUMN_ORDER, rows[1]))
    out = cast_numeric(drop_leaky(raw_df(spark, rows))).orderBy("Date").collect()
    assert out[0]["Price"] is None
    assert math.isnan(out[1]["Price"])
    assert out[2]["Price"] == 8.0


def test_parse_date_malformed_is_null(spark):
    rows = raw_rows(2)
    rows[0] = tuple("2021-13-45" if c == "Date" else v for c, v in zip(RAW_COLUMN_ORDER, rows[0]))
    out = parse_date(raw_df(spark, rows)).collect()
    assert sorted([r["Date"] for r in out], key=lambda d: (d is not None, d)) == [None, BASE + dt.timedelta(days=1)]


# ---------------------------------------------------------------- statistics

def test_exact_median_is_lower_median_and_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),)], "x double")
    assert stats.exact_medians(df, ["x"]) == {"x": 1.0}
    assert stats.approx_medians(df, ["x"]) == {"x": 1.0}


def test_all_null_column_median_is_zero(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert stats.exact_medians(df, ["x", "y"]) == {"x": 0.0, "y": 1.0}
    assert stats.approx_medians(df, ["x"]) == {"x": 0.0}


def test_radix_selection_matches_brute_force(spark):
    """A hot value, both signs, all powers of two, neighbouring doubles, infinities and zeros."""
    rng = random.Random(7)
    vals = [float(rng.randint(0, 5000)) for _ in range(9000)] + [42.0] * 5000
    rng.shuffle(vals)
    columns = {
        "a": vals,
        "b": [rng.gauss(0, 1) for _ in vals],
        "c": [math.ldexp(rng.choice([-1, 1]) * (1 + rng.random()), rng.randint(-1074, 1020)) for _ in vals],
        "d": [1.0 + rng.randint(0, 5000) * 2.0**-52 for _ in vals],
        "e": [rng.choice([float("inf"), float("-inf"), 0.0, -0.0, 5e-324, 1.7976931348623157e308, -3.5]) for _ in vals],
        "f": [math.nextafter(2.0 ** rng.randint(-3, 3), rng.choice([0, 9])) for _ in vals],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    for fraction in (0.5, 0.01, 1.0):
        got = stats.select_quantile(df, list(columns), fraction)
        for c, v in columns.items():
            assert got[c] == sorted(v)[max(1, math.ceil(fraction * len(v))) - 1], (c, fraction)
    near = stats.select_quantile(df, list(columns), 0.5, 0.01)
    for c, v in columns.items():  # rank within the guaranteed error
        assert sum(x < near[c] for x in v) - 0.01 * len(v) <= (len(v) + 1) // 2 <= sum(x <= near[c] for x in v) + 0.01 * len(v)


def test_radix_selection_takes_four_passes_at_most(spark, monkeypatch):
    """Passes are counted by their cell functions; distinct values are never shuffled."""
    rng = random.Random(3)
    df = spark.createDataFrame([(1.0 + rng.randint(0, 2**50) * 2.0**-52,) for _ in range(3000)], "x double")
    passes, real = [], stats._next_cell
    monkeypatch.setattr(stats, "_next_cell", lambda v, lo, hi: passes.append(hi - lo) or real(v, lo, hi))
    v = sorted(r[0] for r in df.collect())
    assert stats.exact_medians(df, ["x"]) == {"x": v[1499]} and len(passes) <= 3
    monkeypatch.setattr(stats, "_next_cell", lambda v, lo, hi: pytest.fail("a column of few values needs one pass"))
    assert stats.exact_medians(spark.createDataFrame([(float(i % 3),) for i in range(300)], "x double"), ["x"]) == {"x": 1.0}


def test_mode_tie_smallest_value_and_unknown(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c string, d string")
    assert stats.modes(df, ["c", "d"]) == {"c": "a", "d": "UNKNOWN"}


def test_frequent_values_are_proven_without_counting_all(spark, monkeypatch):
    """A tenth of the rows hold one value among half a million others: only candidates are counted."""
    n = 500_000
    df = spark.range(n).select(F.when(F.col("id") % 10 == 3, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("a"),
                               F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("b"))
    df = df.unionAll(spark.createDataFrame([(None, "1"), (None, "1")], "a string, b string"))
    monkeypatch.setattr(stats, "category_counts", lambda *a, **k: pytest.fail("all values are counted"))
    assert stats.modes(df, ["a", "b"]) == {"a": "hot", "b": "1"}


def test_modes_without_a_frequent_value_are_counted(spark):
    """All values twice, and a tie of two: the bound proves nothing for the first, ties go to the smallest."""
    df = spark.range(60_000).select(F.concat(F.lit("v"), F.lpad((F.col("id") % 30_000).cast("string"), 6, "0")).alias("a"),
                                    F.when(F.col("id") % 2 == 0, "y").otherwise("x").alias("b"))
    assert stats.frequent_modes(df, ["a", "b"]) == {"b": "x"}
    assert stats.modes(df, ["a", "b"]) == {"a": "v000000", "b": "x"}
    assert stats.modes(df.where("false"), ["a", "b"]) == {"a": "UNKNOWN", "b": "UNKNOWN"}


def test_value_counts_order(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("z",)], "c string")
    assert [tuple(r) for r in stats.value_counts(df, "c").collect()] == [("y", 2), ("x", 1), ("z", 1)]


# ---------------------------------------------------------------- imputation

def test_median_and_mode_fill_nulls_not_nan(spark):
    rows = raw_rows(5)
    rows[0] = tuple(None if c in ("Price", "Region") else v for c, v in zip(RAW_COLUMN_ORDER, rows[0]))
    rows[1] = tuple("NaN" if c == "Inventory Level" else v for c, v in zip(RAW_COLUMN_ORDER, rows[1]))
    df = prepare_raw(raw_df(spark, rows))
    out = impute_missing(df, method="exact").orderBy("Date").collect()
    assert out[0]["Price"] == 8.0
    assert out[0]["Region"] in ("Coast", "Inland")
    assert math.isnan(out[1]["Inventory Level"])  # NaN is not null: survives imputation


def test_mode_fill_value(spark):
    rows = raw_rows(4, Category=lambda s, p, i, r: None if i == 0 else ("Toys" if i < 3 else "Books"))
    out = impute_missing(prepare_raw(raw_df(spark, rows))).orderBy("Date").collect()
    assert out[0]["Category"] == "Toys"


def test_fit_on_train_only_option(spark):
    rows = raw_rows(10, Price=lambda s, p, i, r: None if i == 9 else ("1.00" if i < 5 else "9.00"))
    typed = prepare_raw(raw_df(spark, rows))
    fitted = fit_imputer(split_train(typed, RETAIL.with_(cutoff="2021-03-06")), method="exact")
    assert fitted.medians["Price"] == 1.0
    assert apply_imputer(typed, fitted).where(F.col("Date") == "2021-03-10").first()["Price"] == 1.0


# ---------------------------------------------------------------- calendar

@pytest.mark.parametrize("week_start,expected", [
    ("monday0", {"2022-05-16": (0, 0), "2022-05-20": (4, 0), "2022-05-21": (5, 1), "2022-05-22": (6, 1)}),
    ("sunday0", {"2022-05-16": (1, 0), "2022-05-20": (5, 1), "2022-05-21": (6, 1), "2022-05-22": (0, 0)}),
])
def test_day_of_week_conventions(spark, week_start, expected):
    rows = raw_rows(7, start=dt.date(2022, 5, 16))
    df = engineer_features(prepare_raw(raw_df(spark, rows)), RETAIL.with_(week_start=week_start))
    got = {r["Date"].isoformat(): (r["day_of_week"], r["is_weekend"]) for r in df.collect()}
    for d, v in expected.items():
        assert got[d] == v


def test_null_date_weekend_is_zero(spark):
    rows = raw_rows(3)
    rows[1] = tuple(None if c == "Date" else v for c, v in zip(RAW_COLUMN_ORDER, rows[1]))
    df = engineer_features(prepare_raw(raw_df(spark, rows)))
    r = df.where(F.col("Date").isNull()).first()
    assert r["is_weekend"] == 0 and r["day_of_week"] is None


def test_calendar_parts(spark):
    df = engineer_features(prepare_raw(raw_df(spark, raw_rows(1, start=dt.date(2020, 12, 31)))))
    r = df.first()
    assert (r["day_of_month"], r["week_of_year"], r["month"], r["quarter"], r["year"]) == (31, 53, 12, 4, 2020)


# ---------------------------------------------------------------- price / lags / rolling

def test_price_features(spark):
    r = engineer_features(prepare_raw(raw_df(spark, raw_rows(1)))).first()
    assert r["price_vs_competitor"] == pytest.approx(1.25)
    assert r["discount_pct"] == pytest.approx(0.6 / 8.000001)


def test_lags_are_row_based_and_start_null(spark):
    # a gap: day 3 is missing, so lag 1 of day 4 is day 2 (row lag, not calendar lag)
    rows = [r for i, r in enumerate(raw_rows(6)) if i != 3]
    out = engineer_features(prepare_raw(raw_df(spark, rows))).orderBy("Date").collect()
    assert out[0]["demand_lag_1"] is None
    assert [r["demand_lag_1"] for r in out[1:]] == [10.0, 11.0, 12.0, 14.0]


def test_rolling_mean_std_exclude_current_row(spark):
    out = engineer_features(prepare_raw(raw_df(spark, raw_rows(10)))).orderBy("Date").collect()
    # demand 10, 11, ..., day 7 (index 7): previous 7 rows 10..16 -> mean 13
    assert out[7]["demand_roll_mean_7"] == pytest.approx(13.0)
    assert out[7]["demand_roll_std_7"] == pytest.approx(math.sqrt(sum((x - 13) ** 2 for x in range(10, 17)) / 6))
    assert out[0]["demand_roll_mean_7"] is None
    assert out[1]["demand_roll_std_7"] is None  # one value: sample std undefined
    # no look-ahead: the mean never exceeds the maximum of earlier demand
    for i, r in enumerate(out[1:], start=1):
        assert r["demand_roll_mean_7"] <= 10 + i - 1


def test_null_date_sorts_first_and_feeds_lags(spark):
    rows = raw_rows(3)
    rows[2] = tuple(None if c == "Date" else v for c, v in zip(RAW_COLUMN_ORDER, rows[2]))
    out = engineer_features(prepare_raw(raw_df(spark, rows))).collect()
    first_dated = [r for r in out if r["Date"] == BASE][0]
    assert first_dated["demand_lag_1"] == 12.0  # the null-date row (demand 12) comes first


def test_tie_breaker_orders_duplicate_days(spark):
    rows = raw_rows(3) + [tuple("99" if c == "Demand" else v for c, v in zip(RAW_COLUMN_ORDER, raw_rows(1)[0]))]
    df = prepare_raw(raw_df(spark, rows)).withColumn("seq", F.when(F.col("Demand") == 99, 1).otherwise(0))
    out = engineer_features(df, RETAIL.with_(tie_breakers=("seq",))).orderBy("Date", "seq").collect()
    assert [r["demand_lag_1"] for r in out] == [None, 10.0, 99.0, 11.0]


def test_nan_text_poisons_frames_and_is_dropped(spark):
    rows = raw_rows(40, demand=lambda i: "NaN" if i == 35 else 10 + i)
    df = drop_incomplete(engineer_features(impute_missing(prepare_raw(raw_df(spark, rows)))))
    dates = {r["Date"] for r in df.collect()}
    assert BASE + dt.timedelta(days=35) not in dates  # NaN target dropped
    assert BASE + dt.timedelta(days=36) not in dates  # lag 1 is NaN


# ---------------------------------------------------------------- filter / split

def test_dropna_removes_warmup_rows(spark):
    df = engineer_features(impute_missing(prepare_raw(raw_df(spark, raw_rows(40)))))
    assert drop_incomplete(df).count() == 40 - 28


def test_split_boundary_goes_to_validation(spark):
    spec = RETAIL.with_(cutoff="2022-07-01")
    rows = raw_rows(40, start=dt.date(2022, 5, 22))  # its last day is 30 June, the one below the cutoff day
    rows += raw_rows(1, start=dt.date(2022, 7, 1), demand=lambda i: 60)
    df = drop_incomplete(engineer_features(impute_missing(prepare_raw(raw_df(spark, rows))), spec), spec)
    train, val = split_train(df, spec), split_validation(df, spec)
    assert train.count() == 41 - 28 - 1
    assert [r["Date"] for r in val.collect()] == [dt.date(2022, 7, 1)]


# ---------------------------------------------------------------- encoding

def test_labels_by_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "Category string")
    m = fit_labels(df, RETAIL.with_(categoricals=("Category",)))
    got = {r["value"]: r["index"] for r in m.labels.collect()}
    assert got == {"c": 0, "a": 1, "b": 2}


def test_unseen_and_null_get_extra_index_not_dropped(spark):
    spec = RETAIL.with_(categoricals=("Category",))
    train = spark.createDataFrame([("x",), ("y",), ("x",)], "Category string")
    val = spark.createDataFrame([("y",), ("new",), (None,)], "Category string")
    m = fit_labels(train, spec)
    enc = drop_unseen(apply_labels(val, m), spec).collect()
    assert sorted(r["Category"] for r in enc) == [1.0, 2.0, 2.0]
    dropped = apply_labels(val, m, unseen="drop").collect()
    assert [r["Category"] for r in dropped] == [1.0]


def test_labels_match_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(c,) for c in "abcbcbdde"], "Category string")
    model = StringIndexer(inputCol="Category", outputCol="i", handleInvalid="keep",
                          stringOrderType="frequencyDesc").fit(df)
    ours = fit_labels(df, RETAIL.with_(categoricals=("Category",)))
    assert {r["value"]: r["index"] for r in ours.labels.collect()} == {v: i for i, v in enumerate(model.labels)}


def test_empty_train_encodes_everything_as_zero_index(spark):
    spec = RETAIL.with_(categoricals=("Category",))
    empty = spark.createDataFrame([], "Category string")
    m = fit_labels(empty, spec)
    val = spark.createDataFrame([("x",)], "Category string")
    assert apply_labels(val, m).first()["Category"] == 0.0


# ---------------------------------------------------------------- whole pipeline

def test_training_matrix_layout(spark):
    from shelfcast.plans.training import build_training_matrix

    spec = RETAIL.with_(cutoff="2022-07-01")
    rows = raw_rows(40, stores=("North Pier", "Quay End"), products=("kettle", "lamp"), start=dt.date(2022, 5, 25))
    res = build_training_matrix(raw_df(spark, rows), spec, median_method="exact")
    assert res.train.columns == list(spec.output_cols)
    assert len(res.train.columns) == 30 and res.train.columns[0] == "Demand"
    # 40 days a series from 25 May: the first 28 are warm-up, 1 to 3 July validate
    assert res.validation.count() == 4 * 3
    assert res.train.count() == 4 * (40 - 28 - 3)


# ---------------------------------------------------------------- hot series

@pytest.mark.parametrize("chunk_rows", [1, 5, 40, 1000])
def test_chunked_hot_series_equals_plain_window(spark, chunk_rows):
    ties = ("seq",)
    rows = raw_rows(60, stores=("North Pier", "Quay End"), products=("kettle",), demand=lambda i: (i * 7) % 23)
    # duplicate days at North Pier (a dense hot series) with a tie-breaker
    rows += raw_rows(60, stores=("North Pier",), products=("kettle",), demand=lambda i: (i * 5) % 17)
    df = prepare_raw(raw_df(spark, rows)).withColumn("seq", F.monotonically_increasing_id()).checkpoint()
    plain = engineer_features(df, RETAIL.with_(tie_breakers=ties, hot_series_rows=None))
    chunked = engineer_features(df, RETAIL.with_(tie_breakers=ties, hot_series_rows=chunk_rows))
    assert chunked.columns == plain.columns
    assert chunked.count() == plain.count() == 180
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_hot_series_assignment_has_halo(spark):
    from shelfcast.operators.features import chunk_hot_series

    df = prepare_raw(raw_df(spark, raw_rows(100)))
    a = chunk_hot_series(df, RETAIL.with_(hot_series_rows=40)).orderBy("Date").collect()
    assert {r["_chunk"] for r in a} == {0, 1, 2}
    # the 30 rows before each chunk start lend history to it
    lend = [r["Date"] for r in a if r["_halo"]]
    assert len(lend) == 60 and all(len(r["_halo"]) == 1 for r in a if r["_halo"])


def test_hot_series_from_filled_null_keys(spark):
    """Null store ids filled with the mode pile onto one series; the chunked window, found
    from the fit's series totals, equals the plain window."""
    rows = raw_rows(50, stores=("North Pier", "Quay End"), products=("kettle",), demand=lambda i: (i * 3) % 11)
    rows += raw_rows(50, stores=("North Pier",), products=("kettle",), demand=lambda i: (i * 7) % 13,
                     Store_ID=lambda s, p, i, r: None)
    typed = prepare_raw(raw_df(spark, rows)).withColumn("seq", F.monotonically_increasing_id()).checkpoint()
    spec = RETAIL.with_(tie_breakers=("seq",), hot_series_rows=40)
    fitted = fit_imputer(typed, spec, method="exact")
    totals = {tuple(r[:2]): r["_total"] for r in fitted.series_totals.collect()}
    assert totals == {("North Pier", "kettle"): 100, ("Quay End", "kettle"): 50}
    imputed = apply_imputer(typed, fitted)
    chunked = engineer_features(imputed, spec, fitted.series_totals)
    plain = engineer_features(imputed, spec.with_(hot_series_rows=None))
    assert chunked.count() == plain.count() == 150
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_distributed_label_rank_equals_window_rank(spark):
    rng = random.Random(3)
    vals = [f"v{rng.randint(0, 400)}" for _ in range(5000)] + ["hot"] * 1500
    df = spark.createDataFrame([(v, f"c{i % 7}") for i, v in enumerate(vals)], "Category string, Region string")
    spec = RETAIL.with_(categoricals=("Category", "Region"))
    one_task = fit_labels(df, spec).labels
    spread = fit_labels(df, spec, rank_in_one_task=50).labels  # Category (402 labels) takes the distributed path
    assert one_task.count() == spread.count() == 402 + 7
    assert one_task.exceptAll(spread).count() == 0 and spread.exceptAll(one_task).count() == 0


@pytest.mark.parametrize("hot", [25, 7, 2_000_000])
def test_chunk_size_never_changes_a_row(spark, hot):
    """One day holds 20 different rows of a series and there are no tie-breakers: the order of all
    other columns decides, in the plain window and in every chunked path."""
    rows = raw_rows(39) + [r for k in range(20) for r in raw_rows(
        1, start=BASE + dt.timedelta(days=20), demand=lambda i: (k * 7) % 20 + 100, Price=lambda s, p, i, r: str(k % 3))]
    df = reliable_checkpoint(prepare_raw(raw_df(spark, rows)))
    plain = engineer_features(df, RETAIL.with_(hot_series_rows=None))
    cut = engineer_features(df, RETAIL.with_(hot_series_rows=hot))
    assert cut.count() == 59 and cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def test_row_exact_chunks_split_a_group_of_copies(spark):
    """One (series, date) holds most rows, many of them identical copies: chunks are cut at
    row positions, and the result equals the plain window."""
    base = raw_rows(40, stores=("North Pier", "Quay End"), products=("kettle",), demand=lambda i: (i * 3) % 11)
    day10 = [r for r in base if r[0] == (BASE + dt.timedelta(days=10)).isoformat() and r[1] == "North Pier"]
    copies = day10 * 150  # 151 identical rows on one (series, date)
    df = prepare_raw(raw_df(spark, base + copies))
    df = reliable_checkpoint(df)
    spec = RETAIL.with_(hot_series_rows=25)
    plain = engineer_features(df, spec.with_(hot_series_rows=None))
    chunked = engineer_features(df, spec)
    assert chunked.count() == plain.count() == 80 + 150
    # identical copies are interchangeable, so the multisets of rows must agree
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_row_exact_chunks_with_tie_breakers(spark):
    rows = raw_rows(30, stores=("North Pier",), products=("kettle",), demand=lambda i: (i * 5) % 13)
    rows += raw_rows(30, stores=("North Pier",), products=("kettle",), start=BASE + dt.timedelta(days=3),
                     demand=lambda i: (i * 7) % 17) * 3
    df = reliable_checkpoint(prepare_raw(raw_df(spark, rows)).withColumn("seq", F.monotonically_increasing_id()))
    spec = RETAIL.with_(tie_breakers=("seq",), hot_series_rows=6)  # 4-row days > half a chunk: row-exact path
    plain = engineer_features(df, spec.with_(hot_series_rows=None))
    chunked = engineer_features(df, spec)
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_approx_median_within_rank_error_of_approx_quantile(spark):
    """Same contract as ``DataFrame.approxQuantile(c, [0.5], 0.001)``: the answer is an
    observed value whose rank is within 0.1% of the middle."""
    from shelfcast.plans.queries import typed_panel

    typed = typed_panel(spark, "/root/testdata/sf0.01")
    ours = stats.approx_medians(typed, ["Price", "Demand"])
    for c in ("Price", "Demand"):
        theirs = typed.approxQuantile(c, [0.5], 0.001)[0]
        vals = sorted(r[0] for r in typed.select(c).where(F.col(c).isNotNull()).collect())
        n = len(vals)
        for v in (ours[c], theirs):
            lo = sum(1 for x in vals if x < v)
            hi = sum(1 for x in vals if x <= v)
            target = (n + 1) // 2
            assert lo - 0.001 * n <= target <= hi + 0.001 * n


def test_assemble_output_skips_missing_columns(spark, caplog):
    df = engineer_features(prepare_raw(raw_df(spark, raw_rows(3)))).drop("Region", "quarter")
    with caplog.at_level("WARNING"):
        out = assemble_output(df)
    assert "Region" not in out.columns and "quarter" not in out.columns
    assert out.columns[0] == "Demand" and len(out.columns) == 28
    assert "not found" in caplog.text


def test_exact_median_of_a_spread_panel_matches_sql_oracle(spark):
    import duckdb

    from oracle import ORACLE
    from shelfcast.plans.queries import SPEC, typed_panel

    sf = "/root/testdata/sf0.01"
    ours = stats.exact_medians(typed_panel(spark, sf).repartition(40), list(SPEC.typed_numerics))
    con = duckdb.connect()
    for t in ["region", "nation", "supplier", "part", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert ours == dict(con.execute(ORACLE["median_exact"]).fetchall())
