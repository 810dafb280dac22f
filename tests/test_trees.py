"""Boosted trees as data give what the fitted model gives."""

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import scoring as S
from shelfcast.plans.model import SERVING_FROM_MATRIX, train_model, train_serving_model
from shelfcast.plans.queries import SPEC, q_training_matrix, q_validation_matrix
from shelfcast.plans.trees import TreeEnsemble, TreeScorer, rmse_per_round
from shelfcast.sources.fixtures import forecast_requests

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def matrices(spark):
    return q_training_matrix(spark, SF).cache(), q_validation_matrix(spark, SF).cache()


@pytest.fixture(scope="module")
def model(matrices):
    return train_model(matrices[0], SPEC, rounds=12, depth=6)


def test_equal_to_the_model_on_every_row(model, matrices):
    trees = TreeEnsemble.of(model)
    for df in matrices:
        out = model.transform(df).select("prediction", trees.prediction([F.col(f"`{c}`") for c in trees.inputs]).alias("ours"))
        far = F.abs(F.col("prediction") - F.col("ours")) > 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))
        assert out.where(far | F.col("ours").isNull()).count() == 0 and out.count() > 10_000


def test_missing_features_go_right_as_in_the_model(spark, model, matrices):
    holes = matrices[1].limit(300).withColumns({c: F.when(F.rand(3) < 0.3, float("nan")).otherwise(F.col(f"`{c}`").cast("double"))
                                                for c in ("Price", "demand_lag_1", "demand_roll_mean_7", "Store ID")})
    holes = spark.createDataFrame(holes.collect(), holes.schema)
    trees = TreeEnsemble.of(model)
    out = model.transform(holes).select("prediction", trees.prediction([F.col(f"`{c}`") for c in trees.inputs]).alias("ours")).collect()
    assert all(r["ours"] == pytest.approx(r["prediction"], abs=1e-9) for r in out)


def test_errors_of_all_rounds_from_one_scan(model, matrices):
    import math

    assembled = model.stages[0].transform(matrices[1])
    want = [math.sqrt(x) for x in model.stages[-1].evaluateEachIteration(assembled, "squared")]
    assert rmse_per_round(model, matrices[1], SPEC.target) == pytest.approx(want, rel=1e-9)


def test_requests_are_scored_in_their_rows(spark, matrices):
    """The same responses as through day rows, from a plan without a generator of days or a shuffle."""
    model = train_serving_model(matrices[0], SPEC, rounds=5, depth=4)
    rows = [(r["request_id"], r["body"]) for r in forecast_requests(spark, "/root/testdata/sf0.001").collect()]
    requests = spark.createDataFrame(rows, "request_id long, body string")
    ours = S.score_requests(requests, TreeScorer(TreeEnsemble.of(model), S.serving_feature_columns))
    theirs = S.score_requests(requests, S.ModelScorer(model))
    assert "Exchange" not in ours._jdf.queryExecution().executedPlan().toString()
    a, b = ({r["request_id"]: r for r in df.collect()} for df in (ours, theirs))
    assert a.keys() == b.keys() and {r["status"] for r in a.values()} >= {200, 400}
    for k, r in a.items():
        assert (r["status"], r["error"]) == (b[k]["status"], b[k]["error"])
        assert [p["date"] for p in r["predictions"] or ()] == [p["date"] for p in b[k]["predictions"] or ()]
        assert [p["forecast"] for p in r["predictions"] or ()] == pytest.approx([p["forecast"] for p in b[k]["predictions"] or ()], abs=1e-9)


def test_a_single_leaf(spark):
    df = spark.createDataFrame([(5.0, *[1.0] * 12)] * 20, ["Demand", *SERVING_FROM_MATRIX.values()])
    model = train_serving_model(df, SPEC, rounds=2, depth=2)
    trees = TreeEnsemble.of(model)
    assert df.select(trees.prediction([F.col(f"`{SERVING_FROM_MATRIX[c]}`") for c in trees.inputs]).alias("p")).first()["p"] == 5.0
