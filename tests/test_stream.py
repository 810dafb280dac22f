"""The file-arrival stream gives the same matrices as one batch run over all files."""

import os

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.queries import SPEC
from shelfcast.plans.training import apply_training_matrix, build_training_matrix
from shelfcast.sources.fixtures import demand_panel_raw
from shelfcast.sources.panel import RAW_SCHEMA, read_panel
from shelfcast.spec import RAW_COLUMN_ORDER, RETAIL
from shelfcast.streaming.arrival import adopt_fit, load_frozen_fit, on_arrival, published_fit
from shelfcast.streaming.series_store import SeriesStore
from tests.conftest import SF_SMALL
from tests.test_operators import raw_rows


def test_stream_equals_batch(spark, scratch):
    raw = demand_panel_raw(spark, SF_SMALL)
    inbox = os.path.join(scratch, "inbox")
    # two arrivals: rows before and after mid-1998
    raw.where("Date < '1998-07-01'").write.option("header", True).csv(os.path.join(inbox, "part1"))
    raw.where("Date >= '1998-07-01'").write.option("header", True).csv(os.path.join(inbox, "part2"))
    out = os.path.join(scratch, "out")
    models = os.path.join(scratch, "models")
    q = on_arrival(spark, os.path.join(inbox, "*"), out, os.path.join(scratch, "ckpt"), SPEC,
                   median_method="exact", max_files_per_trigger=1, fmt="parquet",
                   model_output=models, model_params={"rounds": 3, "depth": 3})
    q.awaitTermination(600)
    assert q.exception() is None
    versions = sorted(os.listdir(models))
    assert versions and all(v.startswith("batch-") for v in versions)  # one model per processed batch
    streamed_train = spark.read.parquet(os.path.join(out, "train"))
    streamed_val = spark.read.parquet(os.path.join(out, "validation"))
    batch = build_training_matrix(read_panel(spark, os.path.join(inbox, "*")), SPEC, median_method="exact")
    for got, want in ((streamed_train, batch.train), (streamed_val, batch.validation)):
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_stream_recomputes_touched_buckets(spark, scratch):
    from shelfcast.plans.training import apply_training_matrix
    from shelfcast.streaming.arrival import BUCKET_COL, load_frozen_fit

    raw = demand_panel_raw(spark, SF_SMALL)
    inbox = os.path.join(scratch, "inbox")
    raw.where("Date < '1999-01-01'").coalesce(1).write.option("header", True).csv(os.path.join(inbox, "a"))
    raw.where("Date >= '1999-01-01'").coalesce(1).write.option("header", True).csv(os.path.join(inbox, "b"))
    out = os.path.join(scratch, "out")
    q = on_arrival(spark, os.path.join(inbox, "*"), out, os.path.join(scratch, "ckpt"), SPEC,
                   median_method="exact", max_files_per_trigger=1, mode="incremental", buckets=8)
    q.awaitTermination(600)
    assert q.exception() is None
    imputer, labels = load_frozen_fit(spark, out, SPEC)
    # the statistics were fitted on the first arrival only, then frozen
    first = build_training_matrix(read_panel(spark, os.path.join(inbox, "a")), SPEC, median_method="exact")
    assert imputer.medians == first.imputer.medians and imputer.modes == first.imputer.modes
    want_train, want_val = apply_training_matrix(read_panel(spark, os.path.join(inbox, "*")), imputer, labels, SPEC)
    for name, want in (("train", want_train), ("validation", want_val)):
        got = spark.read.parquet(os.path.join(out, name)).drop(BUCKET_COL).select(*want.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_stream_resumes_after_restart(spark, scratch):
    from shelfcast.plans.training import apply_training_matrix
    from shelfcast.streaming.arrival import BUCKET_COL, load_frozen_fit

    raw = demand_panel_raw(spark, SF_SMALL)
    inbox = os.path.join(scratch, "inbox")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    raw.where("Date < '1999-01-01'").coalesce(1).write.option("header", True).csv(os.path.join(inbox, "a"))

    def start():
        q = on_arrival(spark, os.path.join(inbox, "*"), out, ckpt, SPEC, median_method="exact",
                       mode="incremental", buckets=8)
        q.awaitTermination(600)
        assert q.exception() is None

    start()
    fit_before = load_frozen_fit(spark, out, SPEC)[0].to_json()
    # a new file arrives while the job is down; the restarted job picks up only that file
    raw.where("Date >= '1999-01-01'").coalesce(1).write.option("header", True).csv(os.path.join(inbox, "b"))
    start()
    imputer, labels = load_frozen_fit(spark, out, SPEC)
    assert imputer.to_json() == fit_before  # the frozen fit was reused, not refitted
    history_batches = sorted(d for d in os.listdir(os.path.join(out, "_history")) if d.startswith("batch_id="))
    assert history_batches == ["batch_id=0", "batch_id=1"]
    want_train, _ = apply_training_matrix(read_panel(spark, os.path.join(inbox, "*")), imputer, labels, SPEC)
    got = spark.read.parquet(os.path.join(out, "train")).drop(BUCKET_COL).select(*want_train.columns)
    assert got.exceptAll(want_train).count() == 0 and want_train.exceptAll(got).count() == 0


def _land(spark, rows, path):
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.option("header", True).csv(path)


def _arrive(spark, scratch, mode="incremental"):
    q = on_arrival(spark, os.path.join(scratch, "inbox", "*"), os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"),
                   RETAIL.with_(cutoff="2021-04-08"), median_method="exact", max_files_per_trigger=1, mode=mode, buckets=4)
    q.awaitTermination(600)
    assert q.exception() is None


def test_columns_are_taken_by_header_name(spark, scratch):
    """A file with two numeric columns swapped lands in the right columns, in the reader and the stream."""
    rows = raw_rows(45)
    _land(spark, rows[:20], os.path.join(scratch, "inbox", "a"))
    swapped = list(RAW_COLUMN_ORDER)
    i, j = swapped.index("Price"), swapped.index("Competitor Pricing")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    (spark.createDataFrame(rows[20:], RAW_SCHEMA).select(*[F.col(f"`{c}`") for c in swapped]).coalesce(1)
     .write.option("header", True).csv(os.path.join(scratch, "inbox", "b")))
    back = read_panel(spark, os.path.join(scratch, "inbox", "*"))
    assert back.select("Price", "Competitor Pricing").distinct().collect() == [("8.00", "6.75")] and back.count() == 45
    _arrive(spark, scratch)
    train = spark.read.parquet(os.path.join(scratch, "out", "train"))
    assert train.count() > 0 and train.select("Price", "Competitor Pricing").distinct().collect() == [(8.0, 6.75)]


def test_short_first_arrival_freezes_nothing(spark, scratch):
    """20 days are less than the longest lag: no labels, so no fit and no matrix until more arrives."""
    rows = raw_rows(60, stores=("North Pier", "Quay End"))
    _land(spark, [r for r in rows if r[0] < "2021-03-21"], os.path.join(scratch, "inbox", "a"))
    _arrive(spark, scratch)
    assert published_fit(spark, os.path.join(scratch, "out")) is None and not os.path.exists(os.path.join(scratch, "out", "train"))
    _land(spark, [r for r in rows if r[0] >= "2021-03-21"], os.path.join(scratch, "inbox", "b"))
    _arrive(spark, scratch)
    train = spark.read.parquet(os.path.join(scratch, "out", "train"))
    assert {r[0] for r in train.select("Store ID").distinct().collect()} == {0.0, 1.0}
    want = build_training_matrix(read_panel(spark, os.path.join(scratch, "inbox", "*")), RETAIL.with_(cutoff="2021-04-08"), median_method="exact").train
    got = train.select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_half_written_fit_is_passed_over(spark, scratch):
    """A fit folder without its marker, as a crash leaves it, does not stop the stream."""
    rows = raw_rows(45)
    _land(spark, rows, os.path.join(scratch, "inbox", "a"))
    spark.createDataFrame([("{}",)], "value string").write.text(os.path.join(scratch, "out", "_fit", "version=000000000000", "imputer"))
    assert published_fit(spark, os.path.join(scratch, "out")) is None
    _arrive(spark, scratch)
    assert load_frozen_fit(spark, os.path.join(scratch, "out"), RETAIL) is not None
    assert spark.read.parquet(os.path.join(scratch, "out", "train")).count() > 0


def test_file_without_a_needed_column_fails(spark, scratch):
    spark.createDataFrame(raw_rows(3), RAW_SCHEMA).drop("Price").coalesce(1).write.option("header", True).csv(os.path.join(scratch, "x"))
    with pytest.raises(ValueError, match="no header"):
        read_panel(spark, os.path.join(scratch, "x"))


def _files(base):
    """Modification time of every data file below a folder."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(base) for f in names if f.startswith("part-")}


def _same_matrices(spark, scratch, spec):
    out = os.path.join(scratch, "out")
    fit = load_frozen_fit(spark, out, spec)
    for name, want in zip(("train", "validation"), apply_training_matrix(read_panel(spark, os.path.join(scratch, "inbox", "*")), *fit, spec)):
        got = spark.read.parquet(os.path.join(out, name)).select(*want.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_arrivals_in_order_read_tails_alone(spark, scratch):
    """Rows that follow their series need the series' last 30 rows and the batch: everything older is made
    unreadable here, and what was written before keeps its files."""
    rows = raw_rows(80, stores=("North Pier", "Quay End", "Old Mill"))
    _land(spark, [r for r in rows if r[0] < "2021-05-01"], os.path.join(scratch, "inbox", "a"))
    _arrive(spark, scratch)
    before = _files(os.path.join(scratch, "out", "train")) | _files(os.path.join(scratch, "out", "validation"))
    hidden = [p for t in ("_history", "_panel") for p in _files(os.path.join(scratch, "out", t))]
    assert before and hidden
    kept = {}
    for p in hidden:
        with open(p, "rb") as f:
            kept[p] = f.read()
        with open(p, "wb") as f:
            f.write(b"not a table")
    _land(spark, [r for r in rows if r[0] >= "2021-05-01"], os.path.join(scratch, "inbox", "b"))
    _arrive(spark, scratch)
    now = _files(os.path.join(scratch, "out", "train")) | _files(os.path.join(scratch, "out", "validation"))
    assert len(now) > len(before) and all(now[p] == t for p, t in before.items())
    tail = spark.read.parquet(os.path.join(scratch, "out", "_tail"))
    assert tail.groupBy("Store ID", "batch").count().agg(F.max("count")).first()[0] == 30
    _same_matrices(spark, scratch, RETAIL.with_(cutoff="2021-04-08"))


def test_late_rows_change_their_months_alone(spark, scratch):
    """One late day of one store: partitions of other buckets, and months out of its reach, keep their files."""
    days = 400
    rows = raw_rows(days, stores=("North Pier", "Quay End", "Old Mill", "Fish Gate"))
    late = [r for r in rows if r[1] == "Quay End" and r[0] == "2021-08-10"]
    assert late
    _land(spark, [r for r in rows if r not in late], os.path.join(scratch, "inbox", "a"))
    _arrive(spark, scratch)
    out = os.path.join(scratch, "out")
    before = {p: t for n in ("train", "validation") for p, t in _files(os.path.join(out, n)).items()}
    _land(spark, late, os.path.join(scratch, "inbox", "b"))
    _arrive(spark, scratch)
    now = {p: t for n in ("train", "validation") for p, t in _files(os.path.join(out, n)).items()}
    gone = {os.path.dirname(os.path.dirname(p)) for p in before if p not in now}
    # the day's month and the next: 21 later rows in August, so nine in September, whatever the series' lengths
    assert {os.path.basename(g) for g in gone} == {"month_key=202108", "month_key=202109"}
    assert len({os.path.basename(os.path.dirname(g)) for g in gone}) == 1  # one bucket
    assert all(now[p] == t for p, t in before.items() if p in now)
    _same_matrices(spark, scratch, RETAIL.with_(cutoff="2021-04-08"))


def test_shuffled_days_and_repeated_rows(spark, scratch):
    """Days arrive in any order, some rows twice, some without a date or a key, on sparse series as well."""
    import random

    rows = raw_rows(150, stores=("North Pier", "Quay End", "Old Mill"))
    r = random.Random(4)
    rows = [x for x in rows if x[1] != "Old Mill" or r.random() < 0.3]
    rows += r.sample(rows, 15)
    odd = [list(x) for x in r.sample(rows, 12)]
    for i, x in enumerate(odd):
        x[0 if i % 2 else 1] = None
    rows += [tuple(x) for x in odd]
    r.shuffle(rows)
    spec = RETAIL.with_(cutoff="2021-04-08")
    whole = build_training_matrix(spark.createDataFrame(rows, RAW_SCHEMA), spec)
    adopt_fit(spark, whole, os.path.join(scratch, "out"))
    for i in range(3):
        _land(spark, rows[i::3], os.path.join(scratch, "inbox", f"p{i}"))
    _arrive(spark, scratch)
    _same_matrices(spark, scratch, spec)


def test_second_try_of_a_batch_changes_nothing(spark, scratch):
    """A batch that failed after its writes is tried again: same tables, no row twice."""
    rows = raw_rows(90, stores=("North Pier", "Quay End"))
    spec = RETAIL.with_(cutoff="2021-04-08")
    out = os.path.join(scratch, "out")
    frame = lambda part: spark.createDataFrame(part, RAW_SCHEMA)
    adopt_fit(spark, build_training_matrix(frame(rows), spec), out)
    fit = load_frozen_fit(spark, out, spec)
    store = SeriesStore(spark, out, spec, 4)
    parts = [rows[:60] + rows[90:150], rows[62:90] + rows[150:], rows[60:62]]
    for i, part in enumerate(parts):
        first = store.add(frame(part), *fit, i)
        assert store.add(frame(part), *fit, i) == first
    assert first["late"] == first["touched"] and len(first["late"]) == 1
    for name, want in zip(("train", "validation"), apply_training_matrix(frame(rows), *fit, spec)):
        got = spark.read.parquet(os.path.join(out, name)).select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
