"""State of the incremental file-arrival job: tails, panel and matrices by series bucket and month.

All tables lie below the job's output and are partitioned by ``series_bucket`` (a hash of the series keys):

* ``_tail``: the last rows of every series, as many as the longest lag or window looks back. A new row that
  follows all rows of its series needs its series' tail and its batch, nothing else.
* ``_panel``: every imputed row, by bucket and month. Only late rows read it.
* ``_counts``: rows per series and month of each batch, from which the months that a late row
  touches are found without reading the panel.
* ``train`` / ``validation``: matrix rows by bucket, month and the batch that wrote them.

A row that enters a series at position p changes the features of positions p to p + look-back and no others.
``late`` turns this into months: those that hold a changed row are computed anew, from themselves and as
many months before as hold the look-back of each of the bucket's series. All other partitions stay untouched.

A batch that is tried again finds the state before it (versions carry the batch id) and
overwrites what its first try wrote. What a batch replaces is deleted after its own files are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.encode import LabelModel
from shelfcast.operators.impute import ImputerStats, apply_imputer
from shelfcast.operators.shaping import prepare_raw
from shelfcast.plans.training import matrices_from_imputed
from shelfcast.sources import files
from shelfcast.spec import PanelSpec

BUCKET_COL, MONTH_COL, BATCH_COL = "series_bucket", "month_key", "batch"
SPLITS = ("train", "validation")


def series_bucket(spec: PanelSpec, buckets: int) -> Column:
    """Hash bucket of the (imputed) series keys."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in spec.series_keys]), F.lit(buckets)).cast("int")


def month_key(spec: PanelSpec, months: int = 1) -> Column:
    """Year and first month of a period of so many months, as one number; 0 for a null date, which comes first."""
    d = F.col(f"`{spec.date}`")
    return F.coalesce(F.year(d) * 100 + F.month(d) - (F.month(d) - 1) % months, F.lit(0)).cast("int")


class SeriesStore:
    """``months``: length of the periods by which tables are partitioned, for sparse series or short histories more than one."""

    def __init__(self, spark: SparkSession, output: str, spec: PanelSpec, buckets: int, fmt: str = "parquet", months: int = 1):
        self.spark, self.base, self.spec, self.buckets, self.fmt, self.months = spark, output.rstrip("/"), spec, buckets, fmt, months
        self.keys = [f"`{k}`" for k in spec.series_keys]

    # ------------------------------------------------------------ reading

    def _partitions(self, path: str) -> list[str]:
        return [name for name in files.children(self.spark, f"{self.base}/{path}") if "=" in name]

    def _versions(self, table: str, before: int) -> dict[int, int]:
        """Newest version of each bucket of a versioned table from a batch before ``before``."""
        out = {}
        for name in self._partitions(table):
            bucket = int(name.split("=")[1])
            held = [int(v.split("=")[1]) for v in self._partitions(f"{table}/{name}")]
            if older := [v for v in held if v < before]:
                out[bucket] = max(older)
        return out

    def started(self) -> int | None:
        """The first batch that the store holds; None while it is empty."""
        held = {int(v.split("=")[1]) for b in self._partitions("_counts") for v in self._partitions(f"_counts/{b}")}
        return min(held, default=None)

    def tails(self, schema, batch_id: int, touched: list[int]) -> DataFrame:
        """Tail rows of the touched buckets as the batch before left them."""
        held = self._versions("_tail", batch_id)
        paths = [f"{self.base}/_tail/{BUCKET_COL}={b}/{BATCH_COL}={held[b]}" for b in touched if b in held]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.base}/_tail").parquet(*paths).select(*[f"`{c}`" for c in schema.fieldNames()])

    def _upto(self, table: str, batch_id: int, schema: str) -> DataFrame:
        """A table that batches append to, without what a later, failed try may have left."""
        return self.spark.read.schema(f"{schema}, {BUCKET_COL} int, {BATCH_COL} int").parquet(f"{self.base}/{table}").where(F.col(BATCH_COL) <= batch_id)

    # ------------------------------------------------------------ writing

    def _write(self, df: DataFrame, table: str, partitions: list[str], fmt: str = "parquet") -> None:
        """Dynamic overwrite: a partition that the frame has is replaced, all others stay."""
        (df.repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partitions).format(fmt).save(f"{self.base}/{table}"))

    def _write_matrices(self, imputed: DataFrame, wanted: Column, labels: LabelModel, batch_id: int) -> None:
        """Matrix rows of the imputed rows that ``wanted`` names; the others only lend history."""
        extra = (BUCKET_COL, MONTH_COL, "_wanted")
        flagged = imputed.withColumn("_wanted", wanted)
        for name, matrix in zip(SPLITS, matrices_from_imputed(flagged, labels, self.spec, keep=extra)):
            out = matrix.where("_wanted").drop("_wanted").withColumn(BATCH_COL, F.lit(batch_id))
            self._write(out, name, [BUCKET_COL, MONTH_COL, BATCH_COL], self.fmt)

    # ------------------------------------------------------------ a batch

    def add(self, raw: DataFrame, imputer: ImputerStats, labels: LabelModel, batch_id: int) -> dict:
        """Bring the rows of a batch into all tables. Returns the buckets it touched and those with late rows."""
        spec, look = self.spec, self.spec.max_lookback
        imputed = apply_imputer(prepare_raw(raw, spec), imputer)
        schema = imputed.schema
        rows = imputed.withColumns({BUCKET_COL: series_bucket(spec, self.buckets), MONTH_COL: month_key(spec, self.months), BATCH_COL: F.lit(batch_id)})
        self._write(rows, "_panel", [BUCKET_COL, MONTH_COL, BATCH_COL])
        # from here on the batch is read from its own partitions of the panel
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", {MONTH_COL} int"
        new = self._upto("_panel", batch_id, ddl).where(F.col(BATCH_COL) == batch_id)
        counts = new.groupBy(*self.keys, MONTH_COL, BUCKET_COL, BATCH_COL).agg(F.count(F.lit(1)).alias("rows"))
        self._write(counts, "_counts", [BUCKET_COL, BATCH_COL])
        touched = sorted(r[0] for r in new.select(BUCKET_COL).distinct().collect())  # at most ``buckets`` numbers

        tail = self.tails(schema, batch_id, touched).withColumn(BUCKET_COL, series_bucket(spec, self.buckets))
        day = f"`{spec.date}`"
        first = new.groupBy(*self.keys, BUCKET_COL).agg(F.min(day).alias("_first"), F.max(F.col(day).isNull()).alias("_undated"))
        last = tail.groupBy(*self.keys).agg(F.max(day).alias("_last"))
        # a series is late if a new row may come before one that it has (a null date comes first, equal dates may)
        late_series = first.join(last, list(spec.series_keys)).where(
            F.col("_undated") | F.col("_last").isNotNull() & (F.col("_first") <= F.col("_last")))
        late = sorted(r[0] for r in late_series.select(BUCKET_COL).distinct().collect())

        is_late = F.col(BUCKET_COL).isin(late)
        fresh = new.drop(BATCH_COL)
        if len(late) < len(touched):
            lent = tail.where(~is_late).withColumn(MONTH_COL, F.lit(-1))
            both = fresh.where(~is_late).unionByName(lent)
            self._write_matrices(both, F.col(MONTH_COL) >= 0, labels, batch_id)
        if late:
            self._late(late, ddl, labels, batch_id)

        recent = Window.partitionBy(*self.keys).orderBy(*[F.desc_nulls_last(f"`{c}`") for c in (spec.date, *spec.tie_breakers, *[
            c for c in schema.fieldNames() if c not in (spec.date, *spec.tie_breakers, *spec.series_keys)])])
        kept = (fresh.drop(MONTH_COL).unionByName(tail).withColumn("_n", F.row_number().over(recent)).where(F.col("_n") <= look).drop("_n")
                .withColumn(BATCH_COL, F.lit(batch_id)))
        self._write(kept, "_tail", [BUCKET_COL, BATCH_COL])
        self._drop_old_tails(touched, batch_id)
        return {"touched": touched, "late": late}

    def _drop_old_tails(self, touched: list[int], batch_id: int) -> None:
        """Keep the version that a second try of this batch needs, and its own."""
        needed = self._versions("_tail", batch_id)
        for b in touched:
            for v in self._partitions(f"_tail/{BUCKET_COL}={b}"):
                n = int(v.split("=")[1])
                if n != batch_id and n != needed.get(b):
                    files.remove(self.spark, f"{self.base}/_tail/{BUCKET_COL}={b}/{v}")

    # ------------------------------------------------------------ late rows

    def touched_months(self, late: list[int], batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(bucket, month) pairs to compute anew, and pairs that they need before them, from the counts alone."""
        look, keys = self.spec.max_lookback, list(self.spec.series_keys)
        key_types = ", ".join(f"`{k}` string" for k in keys)
        counts = (self._upto("_counts", batch_id, f"{key_types}, {MONTH_COL} int, rows long").where(F.col(BUCKET_COL).isin(late))
                  .groupBy(*self.keys, BUCKET_COL, MONTH_COL)
                  .agg(F.sum("rows").alias("rows"), F.max(F.col(BATCH_COL) == batch_id).alias("fresh")))
        ahead = Window.partitionBy(*self.keys, BUCKET_COL).orderBy(MONTH_COL)
        upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
        before = ahead.rowsBetween(Window.unboundedPreceding, -1)
        # rows of the series between the last month with a new row and this one
        total = F.sum("rows").over(upto)
        at = counts.withColumn("_upto", total)
        since = F.last(F.when(F.col("fresh"), F.col("_upto")), ignorenulls=True).over(before)
        changed = (at.withColumn("_gap", F.coalesce(F.sum("rows").over(before), F.lit(0)) - since)
                   .where(F.col("fresh") | (F.col("_gap") < look)).select(BUCKET_COL, MONTH_COL).distinct())
        changed = changed.cache()
        # every series of the bucket needs its look-back before each changed month, whether it has rows there or not
        series = counts.select(*self.keys, BUCKET_COL).distinct()
        marks = series.join(changed, BUCKET_COL).select(*self.keys, BUCKET_COL, MONTH_COL, F.lit(0).cast("long").alias("rows"), F.lit(True).alias("mark"))
        grid = (counts.select(*self.keys, BUCKET_COL, MONTH_COL, "rows", F.lit(False).alias("mark")).unionByName(marks)
                .groupBy(*self.keys, BUCKET_COL, MONTH_COL).agg(F.sum("rows").alias("rows"), F.max("mark").alias("mark")))
        later = Window.partitionBy(*self.keys, BUCKET_COL).orderBy(F.desc(MONTH_COL))
        after = later.rowsBetween(Window.unboundedPreceding, -1)
        grid = grid.withColumn("_after", F.sum("rows").over(later.rowsBetween(Window.unboundedPreceding, 0)))
        # rows after this month up to the next changed one: from the running sums at that month and here
        mark = F.last(F.when(F.col("mark"), F.col("_after")), ignorenulls=True).over(after)
        grid = grid.withColumn("_gap", F.coalesce(F.sum("rows").over(after), F.lit(0)) - mark)
        lend = grid.where((F.col("rows") > 0) & (F.col("_gap") < look)).select(BUCKET_COL, MONTH_COL).distinct()
        return changed, lend

    def _late(self, late: list[int], ddl: str, labels: LabelModel, batch_id: int) -> None:
        changed, lend = self.touched_months(late, batch_id)
        pairs = {tuple(r) for r in changed.collect()}  # at most buckets times months
        read = pairs | {tuple(r) for r in lend.collect()}
        name = F.concat_ws("/", BUCKET_COL, MONTH_COL)
        listed = lambda ps: name.isin([f"{b}/{m}" for b, m in sorted(ps)])
        # on partition columns alone: other partitions are not opened
        rows = self._upto("_panel", batch_id, ddl).where(listed(read)).drop(BATCH_COL)
        self._write_matrices(rows, listed(pairs), labels, batch_id)
        for split in SPLITS:
            for b, m in sorted(pairs):
                folder = f"{split}/{BUCKET_COL}={b}/{MONTH_COL}={m}"
                for v in self._partitions(folder):
                    if v != f"{BATCH_COL}={batch_id}":
                        files.remove(self.spark, f"{self.base}/{folder}/{v}")
        changed.unpersist()
