"""History state of requests: chunks hand their state on, whatever the cut; matrix rows feed the matrix model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.encode import fit_labels
from shelfcast.operators.features import engineer_features
from shelfcast.operators.impute import apply_imputer, fit_imputer
from shelfcast.operators.shaping import prepare_raw
from shelfcast.operators.split import drop_incomplete
from shelfcast.plans import history as H
from shelfcast.plans import scoring as S
from shelfcast.plans.history import KNOWN, attach_history, attach_matrix_features, last_state, matrix_day_features, matrix_known
from shelfcast.spec import RETAIL
from tests.test_operators import raw_df, raw_rows

START = dt.date(2021, 3, 1)


def panel(seed=1):
    """One series with half of all rows, many short ones, repeated days, days without a date."""
    r = random.Random(seed)
    rows = raw_rows(150, stores=("Hot",), demand=lambda i: (i * 7) % 23)
    for i in range(30):
        rows += raw_rows(r.randint(1, 9), stores=(f"S{i:02d}",), start=START + dt.timedelta(days=r.randint(0, 140)), demand=lambda i: i + 1)
    rows += r.sample(rows, 10)
    undated = [list(x) for x in r.sample(rows, 6)]
    for x in undated:
        x[0] = None
    return rows + [tuple(x) for x in undated]


def requests(spark, n=120, seed=2):
    r = random.Random(seed)
    body = [(i, '{"store_id":"%s","item_id":"kettle","date":"%s","horizon":%d}' % (
        r.choice(["Hot", "Hot", f"S{r.randint(0, 32):02d}", "Nowhere"]), START + dt.timedelta(days=r.randint(-3, 170)), r.randint(0, 4))) for i in range(n)]
    return S.validate_requests(spark.createDataFrame(body, "request_id long, body string"))


@pytest.fixture(scope="module")
def fitted(spark):
    typed = prepare_raw(raw_df(spark, panel()), RETAIL)
    fit = fit_imputer(typed)
    imputed = apply_imputer(typed, fit).cache()
    labels = fit_labels(drop_incomplete(engineer_features(imputed, RETAIL, fit.series_totals), RETAIL))
    return imputed, fit, labels


def test_state_is_the_same_however_the_series_is_cut(spark, fitted):
    """Chunks of 25 events, and of 3, fewer than the rows looked back, against brute force."""
    imputed, asked = fitted[0], requests(spark).where("status is null")
    rest = [c for c in imputed.columns if c not in ("Date", "Store ID", "Product ID")]
    low = lambda v: (v is not None, v)
    rows = sorted(imputed.collect(), key=lambda x: (low(x["Date"]), *[low(x[c]) for c in rest]))
    want = {}
    for q in asked.collect():
        before = [x for x in rows if x["Store ID"] == q["store_id"] and x["Product ID"] == q["item_id"] and (x["Date"] is None or x["Date"] < q["date"])]
        seen = bool(before) and before[-1]["Date"] is not None
        want[q["request_id"]] = ([x["Demand"] for x in before[-30:]] if seen else [], before[-1]["Inventory Level"] if seen else None)
    assert sum(len(v) == 30 for v, _ in want.values()) > 20 and any(not v for v, _ in want.values())
    for chunk in (1_000_000, 25, 3):
        got = {r["request_id"]: (r["recent"], r["last"]["Inventory Level"] if r["last"] else None)
               for r in last_state(asked, imputed, RETAIL, 30, chunk_rows=chunk).collect()}
        assert got == want, chunk


def test_no_task_holds_a_whole_series(spark, fitted, monkeypatch):
    """The events of the hot series are dealt to many chunks of bounded size."""
    sizes, real = [], H.reliable_checkpoint

    def seen(df):
        out = real(df)
        if "rid" in df.columns:
            sizes.append([r["count"] for r in out.groupBy("chunk").count().collect()])
        return out

    monkeypatch.setattr(H, "reliable_checkpoint", seen)
    last_state(requests(spark).where("status is null"), fitted[0], RETAIL, 7, chunk_rows=25).count()
    assert len(sizes[0]) > 10 and max(sizes[0]) <= 75  # ranges are sampled


def test_lookup_is_unchanged_by_chunks(spark, fitted):
    imputed, _, labels = fitted
    asked = requests(spark)
    one, cut = (attach_history(asked, imputed, labels, chunk_rows=n).select("request_id", "status", *KNOWN) for n in (10**6, 25))
    assert one.count() == asked.count() and one.exceptAll(cut).count() == 0 and cut.exceptAll(one).count() == 0


def test_matrix_rows_agree_with_the_training_features(spark, fitted):
    """A request for the day after a row sees the lags that the training features give the next row."""
    imputed, fit, labels = fitted
    asked = requests(spark, 300)
    rows = attach_matrix_features(asked, imputed, fit, labels, chunk_rows=25)
    assert rows.where("status is not null").select(*[F.col(f"`{c}`") for c in matrix_known()]).distinct().count() == 1
    trained = engineer_features(imputed, RETAIL).where("`Store ID` = 'Hot' and Date is not null")
    once = trained.groupBy("Date").count().where("count = 1").select("Date")
    both = (rows.where("status is null and store_id = 'Hot'").select(F.col("date").alias("Date"), *[F.col(c).alias(f"got_{c}") for c in RETAIL.lag_cols + RETAIL.rolling_cols])
            .join(trained.join(once, "Date").select("Date", *RETAIL.lag_cols, *RETAIL.rolling_cols), "Date").collect())
    assert len(both) > 50
    for r in both:
        for c in RETAIL.lag_cols + RETAIL.rolling_cols:
            assert r[f"got_{c}"] == pytest.approx(r[c] if r[c] is not None else 0.0, abs=1e-9), c
    unseen = rows.where("status is null and store_id = 'Nowhere'").first()
    assert unseen["Store ID"] == labels.sizes["Store ID"] and unseen["Price"] == fit.medians["Price"] and unseen["demand_roll_mean_30"] == 0.0


def test_empty_history_and_no_requests(spark, fitted):
    imputed, fit, labels = fitted
    asked = requests(spark, 20)
    out = attach_matrix_features(asked, imputed.limit(0), fit, labels)
    assert out.count() == 20 and {r["demand_lag_1"] for r in out.where("status is null").collect()} == {0.0}
    assert attach_matrix_features(asked.limit(0), imputed, fit, labels).count() == 0


def test_the_matrix_model_scores_requests(spark, fitted):
    """A model trained on the 29-column matrix runs on the request path."""
    from shelfcast.plans.model import train_model
    from shelfcast.plans.training import matrices_from_imputed

    imputed, fit, labels = fitted
    train, _ = matrices_from_imputed(imputed, labels, RETAIL.with_(cutoff="2022-01-01"))
    model = train_model(train, rounds=3, depth=3)
    rows = attach_matrix_features(requests(spark), imputed, fit, labels)
    out = S.assemble_responses(S.score_days(rows, S.ModelScorer(model), matrix_known(), matrix_day_features)).collect()
    assert len(out) == 120 and {r["status"] for r in out} == {200, 400}
    assert all(p["forecast"] is not None for r in out if r["status"] == 200 for p in r["predictions"])


def test_a_state_is_looked_up_once_for_requests_that_share_it(spark, fitted, monkeypatch):
    """Forty requests of one series and date are one event and one parse; each still gets its row."""
    seen, real = [], H.reliable_checkpoint
    monkeypatch.setattr(H, "reliable_checkpoint", lambda df: seen.append(out := real(df)) or out)
    imputed, fit, labels = fitted
    parsed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            parsed.add(b.num_rows)
            yield b

    one = requests(spark).where("status is null").limit(1).localCheckpoint()
    many = one.drop("request_id").crossJoin(spark.range(40).withColumnRenamed("id", "request_id")).select(*one.columns).coalesce(1)
    rows = attach_matrix_features(many.mapInArrow(count, many.schema), imputed, fit, labels)
    got = rows.collect()
    assert sorted(r["request_id"] for r in got) == list(range(40)) and len({tuple(r)[1:] for r in got}) == 1
    assert parsed.value == 40
    cut = next(x for x in seen if "rid" in x.columns)
    assert cut.where("side = 0").count() == 1 and cut.where("side = 1").count() == imputed.count()
