"""Benchmark: headline queries on the tables in $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each query runs to completion through the ``noop`` sink (full execution, no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    scratch = tempfile.mkdtemp(prefix="shelfcast-bench-")
    builder = SparkSession.builder
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times without the UI: Spark's event log in the scratch folder
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", "file://" + os.path.join(scratch, "events"))
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("shelfcast-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2) if cpus.isdigit() else 16))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    from shelfcast.plans import queries as Q
    from shelfcast.plans import scoring as S
    from shelfcast.plans.etl import run as etl_run
    from shelfcast.plans.model import train_job
    from shelfcast.sources.fixtures import demand_panel_raw, forecast_requests

    raw_csv = os.path.join(scratch, "raw_panel")
    out = {}

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    def q_panel():
        # derive the raw panel from the TPC-H tables and land it as header CSV (the job's input)
        demand_panel_raw(spark, sf_dir).write.mode("overwrite").option("header", True).csv(raw_csv)

    def q_etl_csv():
        # the whole batch job: raw CSV -> impute -> features -> split -> encode -> CSV matrices
        out["etl"] = etl_run(spark, raw_csv, os.path.join(scratch, "matrices"), Q.SPEC, median_method="approx")

    def q_etl_csv_exact():
        etl_run(spark, raw_csv, os.path.join(scratch, "matrices_exact"), Q.SPEC, median_method="exact")

    def q_plain_plan():
        # the batch job without any of the plan's ideas (tools/plain_plan.py), to compare with
        from tools.plain_plan import run as plain_run

        plain_run(spark, raw_csv, os.path.join(scratch, "matrices_plain"), Q.SPEC)

    def q_features():
        run(Q.q_engineer_features(spark, sf_dir))

    def q_median_exact():
        Q.q_median_exact(spark, sf_dir).collect()

    def q_requests():
        # expression scorer evaluated inside each request row: no explode, no shuffle
        scorer = S.FeatureExpressionScorer(lambda f: f["day_of_month"] + f["month"] / F.lit(100.0))
        run(S.score_requests(forecast_requests(spark, sf_dir), scorer))

    def q_requests_by_row():
        # day rows through a row scorer and one regroup (the path a Spark ML model takes)
        scorer = S.ExpressionScorer(Q.stand_in_forecast(F.col("forecast_date")))
        run(S.score_requests(forecast_requests(spark, sf_dir), scorer))

    def q_responses_from_replies():
        run(Q.q_responses(spark, sf_dir))

    def q_train_job_20_rounds():
        etl = out.get("etl") or etl_run(spark, raw_csv, os.path.join(scratch, "matrices"), Q.SPEC)
        train_job(spark, etl["train"], etl["validation"], os.path.join(scratch, "models"), Q.SPEC, rounds=20)

    def q_features_hot_series():
        # a third of the rows lose both keys, so key filling piles them onto one series;
        # the window runs with that series cut into chunks (exact, same rows as plain)
        from shelfcast.operators.features import engineer_features
        from shelfcast.operators.impute import apply_imputer, fit_imputer
        from shelfcast.operators.shaping import prepare_raw
        from shelfcast.sources.panel import read_panel

        typed = prepare_raw(read_panel(spark, raw_csv), Q.SPEC)
        hit = F.pmod(F.xxhash64("Date", "Store ID", "Product ID"), F.lit(3)) == 0
        skewed = typed.select(
            *[F.when(hit, F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c) if c in ("Store ID", "Product ID")
              else F.col(f"`{c}`") for c in typed.columns]
        )
        spec = Q.SPEC.with_(hot_series_rows=max(1000, int(os.environ.get("BENCH_HOT_ROWS", "20000"))))
        fitted = fit_imputer(skewed, spec)
        run(engineer_features(apply_imputer(skewed, fitted), spec, fitted.series_totals))

    plan = [
        ("panel", q_panel),
        ("etl_csv", q_etl_csv),
        ("etl_csv_exact", q_etl_csv_exact),
        ("plain_plan", q_plain_plan),
        ("features", q_features),
        ("median_exact", q_median_exact),
        ("requests", q_requests),
        ("requests_by_row", q_requests_by_row),
        ("responses_from_replies", q_responses_from_replies),
        ("train_job_20_rounds", q_train_job_20_rounds),
        ("features_hot_series", q_features_hot_series),
    ]
    only = set(sys.argv[1:])
    if only and "panel" not in only:
        only.add("panel")  # the later steps read the landed CSV
    # warm-up (untimed): JVM, class loading and code paths of the batch job, on the
    # smallest tables when present
    run(demand_panel_raw(spark, sf_dir).limit(1))
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        warm_csv = os.path.join(scratch, "warm_raw")
        demand_panel_raw(spark, warm_dir).write.mode("overwrite").option("header", True).csv(warm_csv)
        etl_run(spark, warm_csv, os.path.join(scratch, "warm_out"), Q.SPEC)
    times = {}
    for name, fn in plan:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    if os.environ.get("BENCH_EVENT_LOG"):
        print(f"event log: {os.path.join(scratch, 'events')}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(v for k, v in times.items() if k != "plain_plan"), 3),  # ours alone
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
