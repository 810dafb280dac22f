"""Row counts of plans that Spark leaves out."""

from shelfcast.operators.metrics import RowMetrics


def test_counts_of_plans_left_out_are_null(spark):
    metrics = RowMetrics()
    ran = metrics.observe(spark.range(7), "ran")
    left_out = metrics.observe(spark.range(5), "left out")
    ran.write.format("noop").mode("overwrite").save()
    left_out.join(spark.createDataFrame([], "id long").where("false"), "id").write.format("noop").mode("overwrite").save()
    assert {k: v["rows"] for k, v in metrics.get(timeout=20).items()} == {"ran": 7, "left out": None}
