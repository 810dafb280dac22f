"""Physical-plan checks: the shapes the operators are designed to produce."""

import re

from shelfcast.operators.encode import apply_labels, fit_labels
from shelfcast.operators.features import engineer_features
from shelfcast.operators.split import split_train
from shelfcast.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_features_use_one_window_one_exchange(spark):
    typed = Q.typed_panel(spark, SF_SMALL)
    feats = engineer_features(typed, Q.SPEC)
    logical = optimized(feats)
    assert len(re.findall(r"\bWindow \[", logical)) == 1
    physical = plan(feats.select("demand_lag_1", "demand_roll_std_30"))
    # the window exchange is the only one above the fixture's own aggregation
    top = physical.split("HashAggregate")[0]
    assert top.count("Exchange hashpartitioning") == 1


def test_date_split_is_not_pushed_below_window(spark):
    feats = engineer_features(Q.typed_panel(spark, SF_SMALL), Q.SPEC)
    logical = optimized(split_train(feats, Q.SPEC))
    window_at = logical.index("Window [")
    filter_at = logical.index("Filter (")
    assert filter_at < window_at  # the date filter stays above the window (history feeds lags)


def test_label_join_is_broadcast(spark):
    complete = Q.complete_panel(spark, SF_SMALL)
    train = split_train(complete, Q.SPEC)
    model = fit_labels(train, Q.SPEC)
    enc = apply_labels(train, model)
    assert "BroadcastHashJoin" in plan(enc) or "BroadcastExchange" in plan(enc)


def test_fixture_scan_prunes_columns(spark):
    df = Q.typed_panel(spark, SF_SMALL)
    p = plan(df)
    li_scan = [line for line in p.splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert li_scan, p
    assert "l_comment" not in li_scan[0] and "l_tax" not in li_scan[0]


def test_request_filter_not_inlined(spark):
    df = Q.q_default_horizon(spark, SF_SMALL)
    logical = optimized(df)
    # the status filter sits above the validation generator: JSON is parsed once per row
    assert logical.index("Filter") < logical.index("Generate")
