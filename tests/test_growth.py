"""Work that must grow with the rows alone."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features
from shelfcast.operators.features import engineer_features
from shelfcast.operators.shaping import prepare_raw
from shelfcast.plans import queries as Q
from shelfcast.plans.trees import TreeEnsemble
from shelfcast.session import reliable_checkpoint
from shelfcast.spec import RETAIL
from tests.conftest import SF_SMALL
from tests.test_operators import BASE, raw_df, raw_rows


@pytest.mark.parametrize("range_rows, parts", [(250_000, 1), (40, 5)])
def test_short_chunks_make_no_more_range_partitions(spark, monkeypatch, range_rows, parts):
    """Rows are placed in range partitions of their own size, however short the chunks are; the features are those
    of the plain window either way."""
    rows = raw_rows(40, demand=lambda i: (i * 3) % 11) + raw_rows(1, start=BASE + dt.timedelta(days=10)) * 150
    df = reliable_checkpoint(prepare_raw(raw_df(spark, rows)))
    plain = engineer_features(df, RETAIL.with_(hot_series_rows=None))
    seen = []

    def spy(frame):
        if "__pid" in frame.columns:
            seen.append(frame.rdd.getNumPartitions())
        return reliable_checkpoint(frame)

    monkeypatch.setattr(features, "reliable_checkpoint", spy)
    monkeypatch.setattr(features, "RANGE_ROWS", range_rows, raising=False)
    cut = engineer_features(df, RETAIL.with_(hot_series_rows=5))
    assert seen == [parts]
    assert cut.count() == 190 and cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def test_trees_are_walked_for_many_rows_at_once(spark):
    """A batch takes a few array steps a tree and level: two hundred thousand rows of a hundred trees take seconds.
    Null lists, empty lists, nulls and NaN inside rows give what the definition says."""
    n = 100 * 127
    nodes = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "root": [], "weight": [0.5] * 100}
    for tree in range(100):
        first = tree * 127
        nodes["root"].append(first)
        for i in range(127):
            inner = i < 63
            nodes["feature"].append(i % 3 if inner else -1)
            nodes["threshold"].append(float(i % 5))
            nodes["left"].append(first + 2 * i + 1 if inner else -1)
            nodes["right"].append(first + 2 * i + 2 if inner else -1)
            nodes["value"].append(float((tree * 31 + i) % 17))
    trees = TreeEnsemble(["a", "b", "c"], nodes, 6)

    def one(row):
        total = 0.0
        for root, w in zip(nodes["root"], nodes["weight"]):
            at = root
            while nodes["feature"][at] >= 0:
                v = row[nodes["feature"][at]]
                at = nodes["left" if v is not None and v <= nodes["threshold"][at] else "right"][at]
            total += nodes["value"][at] * w
        return total

    rows = [[1.0, 2.0, 3.0], [None, 0.0, 9.0], [float("nan"), 4.0, None], [0.0, 0.0, 0.0]]
    df = spark.createDataFrame([(0, rows), (1, None), (2, []), (3, rows[:1])], "k int, rows array<array<double>>")
    got = {r["k"]: r["p"] for r in df.select("k", trees.predictions(F.col("rows")).alias("p")).collect()}
    assert got == {0: [one(r) for r in rows], 1: None, 2: [], 3: [one(rows[0])]}
    assert len(nodes["feature"]) == n
    many = spark.range(200_000).select(*[(F.col("id") % m).cast("double").alias(c) for c, m in (("a", 7), ("b", 5), ("c", 3))])
    start = time.time()
    total = many.select(trees.prediction([F.col(c) for c in "abc"]).alias("p")).agg(F.sum("p")).first()[0]
    want = sum(one([float(i % 7), float(i % 5), float(i % 3)]) * (200_000 // 105 + (i < 200_000 % 105)) for i in range(105))
    assert total == pytest.approx(want) and time.time() - start < 60


@pytest.mark.parametrize("name, table", [("encode_train", "lineitem"), ("validation_matrix", "lineitem"), ("sorted_export", "lineitem"),
                                         ("history_matrix_rows", "lineitem"), ("responses", "orders")])
def test_source_tables_are_read_once(spark, name, table):
    """Queries that pass over a derived table several times read it from where it was written, not its sources again."""
    df = Q.QUERIES[name](spark, SF_SMALL)
    assert not [f for f in df.inputFiles() if table in f] and df.limit(1).count() == 1
