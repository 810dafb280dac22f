"""Request scoring on hand-made request bodies (the handler's own test cases and traps)."""

import json
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import scoring as S

MSG_HORIZON = "horizon must be an integer between 1 and 30"


def requests(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")


def body(**kw):
    base = {"store_id": "pier-7", "item_id": "lamp", "date": "2019-08-29"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def outcome(spark, bodies):
    rows = S.validate_requests(requests(spark, bodies)).orderBy("request_id").collect()
    return [(r["status"], r["error"]) for r in rows]


def test_valid_single_and_multi_day(spark):
    scorer = S.ExpressionScorer(F.lit(31.25))
    out = S.score_requests(requests(spark, [body(horizon=1), body(horizon=3)]), scorer).orderBy("request_id").collect()
    assert out[0]["status"] == 200 and len(out[0]["predictions"]) == 1
    assert [p["date"] for p in out[1]["predictions"]] == ["2019-08-30", "2019-08-31", "2019-09-01"]
    assert out[1]["predictions"][0]["forecast"] == 31.25
    resp = json.loads(out[1]["response_body"])
    assert resp["store_id"] == "pier-7" and resp["item_id"] == "lamp" and len(resp["predictions"]) == 3


def test_default_horizon_is_one(spark):
    v = S.validate_requests(requests(spark, [body()])).first()
    assert v["status"] is None and v["horizon"] == 1 and v["horizon_defaulted"]


@pytest.mark.parametrize("b,expected", [
    (body(store_id=...), (400, "store_id is required")),
    (body(store_id=""), (400, "store_id is required")),
    (body(store_id=0), (400, "store_id is required")),
    (body(item_id=...), (400, "item_id is required")),
    (body(item_id=[]), (400, "item_id is required")),
    (body(date="29/08/2019"), (400, "date must be in YYYY-MM-DD format")),
    (body(date="2019-04-31"), (400, "date must be in YYYY-MM-DD format")),
    (body(date=20190829), (400, "date must be in YYYY-MM-DD format")),
    (body(date="2019-8-5"), (None, None)),
    (body(horizon=0), (400, MSG_HORIZON)),
    (body(horizon=-1), (400, MSG_HORIZON)),
    (body(horizon=31), (400, MSG_HORIZON)),
    (body(horizon=100), (400, MSG_HORIZON)),
    (body(horizon="abc"), (400, MSG_HORIZON)),
    (body(horizon="3"), (400, MSG_HORIZON)),
    (body(horizon=3.0), (400, MSG_HORIZON)),
    (body(horizon=None), (400, MSG_HORIZON)),
    (body(horizon=True), (None, None)),
    (body(horizon=False), (400, MSG_HORIZON)),
    (body(store_id=7), (None, None)),
    (body(date="9999-12-31"), (500, "Inference failed: date value out of range")),
    (body(date="9999-12-02", horizon=30), (500, "Inference failed: date value out of range")),
    (body(date="9999-12-01", horizon=30), (None, None)),
    ("not json", (400, "Invalid request body")),
    ("[1, 2]", (500, "Inference failed: 'list' object has no attribute 'get'")),
    (None, (500, "Inference failed: the JSON object must be str, bytes or bytearray, not NoneType")),
    ("true", (500, "Inference failed: 'bool' object has no attribute 'get'")),
    ("3.5", (500, "Inference failed: 'float' object has no attribute 'get'")),
    ('"text"', (500, "Inference failed: 'str' object has no attribute 'get'")),
    ("null", (500, "Inference failed: 'NoneType' object has no attribute 'get'")),
    ("{}", (400, "store_id is required")),
    ('{"store_id": "S", "item_id": "I", "date": " 2019-08-29"}', (400, "date must be in YYYY-MM-DD format")),
    ('{"store_id": "S", "item_id": "I", "date": "2019-08- 5"}', (None, None)),
])
def test_validation_rules(spark, b, expected):
    assert outcome(spark, [b]) == [expected]


def test_first_failing_rule_wins(spark):
    assert outcome(spark, [body(store_id="", item_id="", horizon=0)]) == [(400, "store_id is required")]


def test_serving_features_and_payload(spark):
    valid = S.valid_requests(S.validate_requests(requests(spark, [body(horizon=2)])))
    feats = S.serving_features(S.expand_horizon(valid)).orderBy("day").collect()
    assert [feats[0][c] for c in S.SERVING_FEATURES] == [0.0, 0.0, 4.0, 30.0, 8.0, 2019.0, 0.0, 0.0, 0.0, 0.0, 50.0, 0.0]
    payload = S.payload_csv(valid).first()["payload"]
    lines = payload.split("\n")
    assert len(lines) == 2 and lines[0].split(",")[0] == "0.0"
    assert lines[0] == "0.0,0.0,4.0,30.0,8.0,2019.0,0.0,0.0,0.0,0.0,50.0,0.0"


def test_fewer_predictions_than_days_truncates(spark):
    reqs = requests(spark, [body(horizon=3)])
    replies = spark.createDataFrame([(0, " 1.5\n2.5\n")], "request_id long, reply string")
    r = S.score_requests_with_replies(reqs, replies).first()
    assert r["status"] == 200
    assert [(p["date"], p["forecast"]) for p in r["predictions"]] == [("2019-08-30", 1.5), ("2019-08-31", 2.5)]


def test_bad_prediction_fails_only_that_request(spark):
    reqs = requests(spark, [body(horizon=2), body(horizon=1)])
    replies = spark.createDataFrame([(0, "1.0\noops"), (1, "3.0")], "request_id long, reply string")
    out = S.score_requests_with_replies(reqs, replies).orderBy("request_id").collect()
    assert out[0]["status"] == 500
    assert out[0]["error"] == "Inference failed: could not convert string to float: 'oops'"
    assert json.loads(out[0]["response_body"]) == {"error": out[0]["error"]}
    assert out[1]["status"] == 200 and out[1]["predictions"][0]["forecast"] == 3.0


def test_rejected_requests_keep_their_status(spark):
    reqs = requests(spark, ["not json", body(horizon=0), body()])
    out = S.score_requests(reqs, S.ExpressionScorer(F.lit(1.0))).orderBy("request_id").collect()
    assert [r["status"] for r in out] == [400, 400, 200]
    assert json.loads(out[0]["response_body"]) == {"error": "Invalid request body"}


def test_duplicate_request_ids_are_scored_separately(spark):
    reqs = spark.createDataFrame([(7, body(horizon=2)), (7, body(horizon=3)), (7, "not json")],
                                 "request_id long, body string")
    out = S.score_requests(reqs, S.ExpressionScorer(F.lit(1.0))).collect()
    assert sorted((r["status"], len(r["predictions"] or [])) for r in out) == [(200, 2), (200, 3), (400, 0)]


def test_requests_scored_by_trained_serving_model(spark):
    from shelfcast.plans.model import train_serving_model
    from shelfcast.plans.queries import q_training_matrix

    model = train_serving_model(q_training_matrix(spark, "/root/testdata/sf0.001"), rounds=3, depth=3)
    out = S.score_requests(requests(spark, [body(horizon=3), "not json"]), S.ModelScorer(model)).orderBy("request_id").collect()
    assert out[0]["status"] == 200 and len(out[0]["predictions"]) == 3
    assert all(isinstance(p["forecast"], float) for p in out[0]["predictions"])
    assert out[1]["status"] == 400


def test_in_row_scorer_matches_row_scorer(spark):
    reqs = requests(spark, [body(horizon=3), body(horizon=30), "not json", body(horizon=0)])
    in_row = S.score_requests(reqs, S.FeatureExpressionScorer(lambda f: f["day_of_month"] * 2 + f["price"]))
    by_row = S.score_requests(reqs, S.ExpressionScorer(F.dayofmonth("forecast_date") * 2 + F.lit(50.0)))
    assert in_row.exceptAll(by_row).count() == 0 and by_row.exceptAll(in_row).count() == 0
    plan = in_row._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no shuffle on the in-row path


def test_duplicate_replies_fail_instead_of_pairing(spark):
    reqs = requests(spark, [body(horizon=1), body(horizon=1)])
    replies = spark.createDataFrame([(0, "1.0"), (0, "2.0"), (1, "3.0")], "request_id long, reply string")
    out = S.score_requests_with_replies(reqs, replies).orderBy("request_id").collect()
    assert len(out) == 2
    assert out[0]["status"] == 500 and "more than one reply" in out[0]["error"]
    assert out[1]["status"] == 200 and out[1]["predictions"][0]["forecast"] == 3.0


@pytest.mark.parametrize("text,value", [("1_000", 1000.0), ("1.", 1.0), (" .5e2 ", 50.0), ("+Infinity", float("inf")), ("1.5d", None), ("2f", None),
                                        ("0x1p3", None), ("1__0", None), ("_1", None), ("1e", None), ("", None), (".", None)])
def test_reply_numbers_follow_python(spark, text, value):
    got = spark.createDataFrame([(text,)], "t string").select(S.python_float(F.col("t")).alias("v")).first()["v"]
    assert got == value
    try:
        assert float(text) == value
    except ValueError:
        assert value is None


def test_nan_forecast_stays_a_number(spark):
    replies = spark.createDataFrame([(0, "nan\n-inf")], "request_id long, reply string")
    r = S.score_requests_with_replies(requests(spark, [body(horizon=2)]), replies).first()
    assert r["status"] == 200 and '"forecast": NaN' in r["response_body"] and '"forecast": -Infinity' in r["response_body"]
    assert math.isnan(json.loads(r["response_body"])["predictions"][0]["forecast"])


def test_response_text_is_that_of_json_dumps(spark):
    """Separators and escapes of ``json.dumps``, also inside echoed values of any JSON type."""
    from shelfcast.plans.scoring import FeatureExpressionScorer

    stores = ["Köln", "東京 \U0001F600", 'a "b", c: d\\', "tab\t,nl\n", ["x,y", "ü:z", 1], {"k": [1, 2], "l": {"m": "n: o"}}, 7, True]
    bodies = [body(store_id=s, horizon=2) for s in stores] + [body(horizon=99)]
    out = S.score_requests(requests(spark, bodies), FeatureExpressionScorer(lambda f: F.lit(1.5))).orderBy("request_id").collect()
    for r in out:
        assert r["response_body"] == json.dumps(json.loads(r["response_body"]))
    assert [json.loads(r["response_body"])["store_id"] for r in out[:-1]] == stores
    assert out[-1]["response_body"].startswith('{"error": "')
