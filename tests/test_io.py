"""Sources and sinks: raw CSV round trip, matrix files, the batch job, model artifacts."""

import os

from pyspark.sql import functions as F

from shelfcast.sources.fixtures import demand_panel_raw
from shelfcast.sources.panel import read_matrix, read_panel, write_matrix
from shelfcast.spec import RAW_COLUMN_ORDER
from tests.conftest import SF_SMALL


def test_raw_csv_round_trip(spark, scratch):
    raw = demand_panel_raw(spark, SF_SMALL)
    path = os.path.join(scratch, "raw")
    raw.write.option("header", True).csv(path)
    back = read_panel(spark, path)
    assert back.columns == list(RAW_COLUMN_ORDER)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_matrix_write_read_round_trip(spark, scratch):
    from shelfcast.plans.queries import q_training_matrix

    m = q_training_matrix(spark, SF_SMALL)
    path = os.path.join(scratch, "train")
    write_matrix(m, path)
    first = spark.read.text(path).first()["value"].split(",")
    float(first[0])  # headerless: the first field is the target value
    back = read_matrix(spark, path)
    assert back.columns == m.columns
    cast = m.select([F.col(f"`{c}`").cast("double").alias(c) for c in m.columns])
    assert back.exceptAll(cast).count() == 0 and cast.exceptAll(back).count() == 0


def test_etl_run_end_to_end(spark, scratch):
    from shelfcast.plans.etl import run
    from shelfcast.plans.queries import SPEC

    src = os.path.join(scratch, "data")
    demand_panel_raw(spark, SF_SMALL).write.option("header", True).csv(src)
    out = os.path.join(scratch, "out") + "/"
    report = run(spark, src, out, SPEC, median_method="exact")
    assert os.path.isdir(os.path.join(scratch, "out", "train"))
    assert os.path.isdir(os.path.join(scratch, "out", "validation"))
    train = read_matrix(spark, report["train"])
    assert train.count() == 35 and len(train.columns) == 30
    rows = {k: v["rows"] for k, v in report["rows"].items()}
    assert rows["raw"] == rows["imputed"] == rows["before_drop"] == 5963
    assert rows["after_drop"] == 415
    assert rows["train_before_encoding"] == rows["train"] == 35
    assert rows["validation_before_encoding"] == rows["validation"] == 380
    assert report["rows"]["train"]["columns"] == 30


def test_model_train_evaluate_save_load(spark, scratch):
    from shelfcast.plans.model import evaluate, load_model, rmse_per_round, save_model, train_model
    from shelfcast.plans.queries import q_training_matrix, q_validation_matrix

    train = q_training_matrix(spark, "/root/testdata/sf0.01")
    val = q_validation_matrix(spark, "/root/testdata/sf0.01")
    model = train_model(train, rounds=10, depth=6)
    ev = evaluate(model, train, val)
    assert ev.train_rmse < ev.validation_rmse * 2
    assert ev.baseline_rmse is not None
    assert ev.validation_rmse < ev.baseline_rmse  # beats the naive lag-7 forecast
    curve = rmse_per_round(model, train)
    assert len(curve) == 10 and curve[-1] < curve[0]  # boosting lowers the training error
    path = save_model(model, os.path.join(scratch, "models"), version="20240101-000000")
    again = load_model(path)
    a = model.transform(val).select("prediction").collect()
    b = again.transform(val).select("prediction").collect()
    assert a == b


def test_train_job_reads_matrices_and_saves_version(spark, scratch):
    from shelfcast.plans.model import train_job
    from shelfcast.plans.queries import q_training_matrix, q_validation_matrix
    from shelfcast.sources.panel import write_matrices

    tr, va = write_matrices(q_training_matrix(spark, "/root/testdata/sf0.01"),
                            q_validation_matrix(spark, "/root/testdata/sf0.01"), os.path.join(scratch, "m"))
    report = train_job(spark, tr, va, os.path.join(scratch, "models"), rounds=5, depth=4, version="v1")
    assert report["model_path"].endswith("/v1")
    assert len(report["train_rmse_per_round"]) == 5
    assert report["train_rmse_per_round"][-1] < report["train_rmse_per_round"][0]
    assert os.path.isdir(os.path.join(scratch, "models", "v1", "model"))


def test_ordered_export(spark):
    from shelfcast.plans.queries import SPEC
    from shelfcast.plans.training import build_training_matrix

    res = build_training_matrix(demand_panel_raw(spark, SF_SMALL), SPEC, median_method="exact", order="global")
    years = [r["year"] for r in res.validation.collect()]
    assert years == sorted(years)


def test_etl_cli_and_saved_fit(spark, scratch):
    from shelfcast.operators.encode import LabelModel
    from shelfcast.operators.impute import ImputerStats
    from shelfcast.plans.etl import main

    src = os.path.join(scratch, "data")
    demand_panel_raw(spark, SF_SMALL).write.option("header", True).csv(src)
    out = os.path.join(scratch, "out")
    main(["--input", src, "--output", out, "--cutoff", "2000-01-01", "--median", "exact", "--format", "parquet"])
    assert spark.read.parquet(os.path.join(out, "train")).count() == 35
    stats = ImputerStats.from_json(spark.read.text(os.path.join(out, "_fit", "imputer")).first()["value"])
    assert set(stats.medians) == {"Inventory Level", "Price", "Discount", "Promotion", "Competitor Pricing",
                                  "Epidemic", "Demand"}
    labels = LabelModel.load(spark, os.path.join(out, "_fit", "labels"), ["Store ID", "Product ID"])
    assert labels.sizes["Store ID"] > 0


def test_single_file_export(spark, scratch):
    from shelfcast.plans.queries import q_training_matrix

    path = os.path.join(scratch, "one")
    write_matrix(q_training_matrix(spark, SF_SMALL), path, single_file=True)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1


def test_read_panel_rejects_renamed_header(spark, scratch):
    import pytest

    raw = demand_panel_raw(spark, SF_SMALL).withColumnRenamed("Price", "Unit Price")
    path = os.path.join(scratch, "renamed")
    raw.write.option("header", True).csv(path)
    with pytest.raises(Exception):
        read_panel(spark, path).collect()  # the header is checked whenever columns are read


def test_unseen_drop_changes_validation_counts(spark):
    from shelfcast.plans.queries import SPEC
    from shelfcast.plans.training import build_training_matrix

    res = build_training_matrix(demand_panel_raw(spark, "/root/testdata/sf0.01"), SPEC, median_method="exact",
                                unseen="drop")
    res.train.write.format("noop").mode("overwrite").save()
    res.validation.write.format("noop").mode("overwrite").save()
    rows = {k: v["rows"] for k, v in res.metrics.get(timeout=60).items()}
    assert rows["validation_before_encoding"] == 15295
    assert rows["validation"] == 15276  # rows with a category unseen in training are dropped


def test_partition_ordered_export_sorts_within_partitions_without_shuffle(spark):
    from shelfcast.plans.queries import SPEC
    from shelfcast.plans.training import build_training_matrix

    res = build_training_matrix(demand_panel_raw(spark, SF_SMALL), SPEC, median_method="exact", order="partition")
    plan = res.validation._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    parts = res.validation.select("year", "month", "day_of_month").rdd.glom().collect()
    for rows in parts:
        keys = [(r["year"], r["month"], r["day_of_month"]) for r in rows]
        assert keys == sorted(keys)


def test_metrics_of_a_plan_that_never_ran_do_not_block(spark):
    import time

    from shelfcast.operators.metrics import RowMetrics

    m = RowMetrics()
    ran, idle = m.observe(spark.range(7), "ran"), m.observe(spark.range(9), "idle")
    ran.collect()
    began = time.monotonic()
    got = m.get(timeout=0.8)
    assert time.monotonic() - began < 1.5 and got == {"ran": {"rows": 7, "columns": 1}, "idle": {"rows": None, "columns": 1}}
    assert idle.count() == 9


def test_batch_job_is_repeatable_and_leaves_nothing_staged(spark, scratch):
    """Two runs write the same matrices, and the checkpoint folder holds what it held before."""
    from shelfcast.plans.etl import run
    from shelfcast.plans.queries import SPEC
    from shelfcast.session import ensure_checkpoint_dir
    from shelfcast.sources.files import data_files

    src = os.path.join(scratch, "data")
    demand_panel_raw(spark, "/root/testdata/sf0.01").repartition(5).write.option("header", True).csv(src)
    before = data_files(spark, ensure_checkpoint_dir(spark))
    first, second = (run(spark, src, os.path.join(scratch, name), SPEC) for name in ("one", "two"))
    assert first["medians"] == second["medians"]
    for split in ("train", "validation"):
        a, b = spark.read.text(first[split]), spark.read.text(second[split])
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    assert data_files(spark, ensure_checkpoint_dir(spark)) == before


def test_label_fit_reads_the_categoricals_of_the_training_part(spark, monkeypatch):
    import shelfcast.plans.training as T
    from shelfcast.operators.stats import to_long
    from shelfcast.plans.queries import SPEC
    from shelfcast.session import job_folder

    seen, real = [], T.fit_labels
    monkeypatch.setattr(T, "fit_labels", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    with job_folder(spark):
        T.build_training_matrix(demand_panel_raw(spark, SF_SMALL), SPEC, materialize="checkpoint")
        counted = to_long(seen[0], SPEC.categoricals, "string").groupBy("name", "value").count()
        plan = counted._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert all(c in scan for c in SPEC.categoricals) and "Price" not in scan and "Demand" not in scan and "demand_lag" not in scan
    assert "PartitionFilters: [isnotnull(_split" in plan and "_split#" in plan and "= train)" in plan


def test_incomplete_matrix_is_refused_by_file_name(spark, scratch):
    import pytest

    from shelfcast.sources.panel import check_matrix, matrix_schema

    rows = [(float(i),) * 30 for i in range(40)]
    for fmt in ("csv", "parquet"):
        path = os.path.join(scratch, fmt)
        write_matrix(spark.createDataFrame(rows, matrix_schema()).repartition(4), path, fmt)
        held = check_matrix(spark, path, fmt)
        assert held["rows"] == 40 == read_matrix(spark, path, fmt=fmt).count() and len(held["files"]) == 4 and len(held["columns"]) == 30
        with pytest.raises(ValueError, match=f"it is {fmt}"):
            read_matrix(spark, path, fmt="csv" if fmt == "parquet" else "parquet")
        name = sorted(held["files"])[1]
        with open(os.path.join(path, name), "ab") as f:
            f.write(b"x")
        with pytest.raises(ValueError, match=f"{name} has"):
            read_matrix(spark, path, fmt=fmt)
        os.remove(os.path.join(path, name))
        with pytest.raises(ValueError, match=f"{name} is missing"):
            read_matrix(spark, path, fmt=fmt)
        os.remove(os.path.join(path, "_manifest.json"))
        with pytest.raises(ValueError, match="did not finish"):
            read_matrix(spark, path, fmt=fmt)
        assert read_matrix(spark, path, fmt=fmt, check=False).count() < 40


def test_unpublished_model_is_refused(spark, scratch):
    import pytest

    from shelfcast.plans.model import SERVING_FROM_MATRIX, latest_model, load_model, save_model, train_serving_model

    df = spark.createDataFrame([(float(j), *[float(i * j) for i in range(12)]) for j in range(30)], ["Demand", *SERVING_FROM_MATRIX.values()])
    model = train_serving_model(df, rounds=1, depth=2)
    first = save_model(model, scratch, "20240101-000000")
    second = save_model(model, scratch, "20240102-000000")
    assert latest_model(scratch) == second and load_model(second) is not None
    os.remove(os.path.join(second, "_published"))
    assert latest_model(scratch) == first
    with pytest.raises(ValueError, match="did not finish"):
        load_model(second)
