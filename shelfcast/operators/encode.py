"""Label encoding of categorical columns, fitted on the training rows.

Same contract as a frequency-ordered ``StringIndexer`` with ``handleInvalid="keep"``:
labels are numbered by descending count in the fitted rows (equal counts in
alphabetical order), and an unseen or null value gets one extra index ``n``.

The fitted labels stay a DataFrame ``(column, value, count, index)``. Counting is one
distributed aggregate over all categoricals at once; numbering sorts the distinct
labels of each column (in one task per column up to ``rank_in_one_task`` labels, by a
distributed rank beyond that). Applying is a left join per column: broadcast when that
column's label count is under ``broadcast_limit`` and the text of all labels under
``DEFAULT_BROADCAST_BYTES`` (both counted at fit time), a shuffle
join otherwise, so the encoded table never passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.stats import to_long
from shelfcast.spec import RETAIL, PanelSpec
from shelfcast.session import reliable_checkpoint

DEFAULT_BROADCAST_LIMIT = 1_000_000
#: Label text, over all columns together, up to which label tables are broadcast.
DEFAULT_BROADCAST_BYTES = 64 << 20


@dataclass
class LabelModel:
    labels: DataFrame  # column, value, count, index
    sizes: dict[str, int]
    columns: list[str]
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT
    label_bytes: int = 0  # text of all labels of all columns

    def small(self, column: str) -> bool:
        """Whether a column's table may be broadcast: few labels, and all tables together small."""
        return self.sizes.get(column, 0) <= self.broadcast_limit and self.label_bytes <= DEFAULT_BROADCAST_BYTES

    def save(self, path: str) -> None:
        self.labels.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: list[str],
             broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> "LabelModel":
        labels = spark.read.parquet(path)
        found = labels.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()
        sizes = {r["column"]: r["n"] for r in found}
        return cls(labels, {c: sizes.get(c, 0) for c in columns}, list(columns), broadcast_limit, sum(r["b"] or 0 for r in found))


DEFAULT_RANK_IN_ONE_TASK = 2_000_000


def _label_order(prefix: str = ""):
    return [F.desc(f"{prefix}count"), F.asc(f"{prefix}value")]


def _rank_per_column(counts: DataFrame) -> DataFrame:
    """Number each column's labels in one task per column (for columns of bounded size)."""
    w = Window.partitionBy("name").orderBy(*_label_order())
    return counts.select("name", "value", "count", (F.row_number().over(w) - 1).cast("bigint").alias("index"))


def _rank_distributed(counts: DataFrame, rows_per_part: int) -> DataFrame:
    """Number labels of very large columns without one task per column.

    Range-partition by (column, count desc, value) and checkpoint (stable partition ids);
    number rows inside each (partition, column); add the count of that column's labels in
    earlier partitions, taken from a small per-partition count table.
    """
    total = counts.count()
    parts = max(1, -(-total // rows_per_part))
    ranged = counts.repartitionByRange(parts, F.col("name"), *_label_order()).withColumn("_pid", F.spark_partition_id())
    ranged = reliable_checkpoint(ranged)
    local = Window.partitionBy("_pid", "name").orderBy(*_label_order())
    numbered = ranged.withColumn("_local", F.row_number().over(local) - 1)
    sizes = ranged.groupBy("name", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("name").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("name", "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # offsets: one row per (column, range partition) -- bounded by the partition count
    return numbered.join(F.broadcast(offsets), ["name", "_pid"]).select(
        "name", "value", "count", (F.col("_offset") + F.col("_local")).cast("bigint").alias("index"))


def label_frame(df: DataFrame, cols, rank_in_one_task: int = DEFAULT_RANK_IN_ONE_TASK) -> DataFrame:
    """``(column, value, count, index)`` for every non-null value of every column.

    Columns with at most ``rank_in_one_task`` labels are numbered by a window per column;
    larger ones by a distributed rank (see ``_rank_distributed``).
    """
    return _labels_and_sizes(df, cols, rank_in_one_task)[0]


def _labels_and_sizes(df: DataFrame, cols, rank_in_one_task: int) -> tuple[DataFrame, dict[str, int], int]:
    counts = (
        to_long(df, cols, "string")
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    counts = reliable_checkpoint(counts)
    found = counts.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()
    sizes = {r["name"]: r["n"] for r in found}
    big = [c for c, n in sizes.items() if n > rank_in_one_task]
    small = counts.where(~F.col("name").isin(big)) if big else counts
    ranked = _rank_per_column(small)
    if big:
        ranked = ranked.unionByName(_rank_distributed(counts.where(F.col("name").isin(big)), rank_in_one_task))
    return ranked.withColumnRenamed("name", "column"), sizes, sum(r["b"] or 0 for r in found)


def fit_labels(train: DataFrame, spec: PanelSpec = RETAIL, cols=None,
               broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, materialize: bool = True,
               rank_in_one_task: int = DEFAULT_RANK_IN_ONE_TASK) -> LabelModel:
    cols = [c for c in (spec.categoricals if cols is None else cols) if c in train.columns]
    labels, sizes, size_bytes = _labels_and_sizes(train, cols, rank_in_one_task)
    if materialize:
        # Reliable checkpoint in the shared checkpoint folder: the numbered label table is
        # computed once, and the label joins do not re-run the training lineage.
        labels = reliable_checkpoint(labels)
    return LabelModel(labels, {c: sizes.get(c, 0) for c in cols}, cols, broadcast_limit, size_bytes)


def apply_labels(df: DataFrame, model: LabelModel, unseen: str = "index") -> DataFrame:
    """Replace each categorical with its label index (double).

    ``unseen="index"``: unseen or null -> ``n`` (as fitted); ``unseen="drop"``: such rows are removed.
    """
    if unseen not in ("index", "drop"):
        raise ValueError(f"unseen must be 'index' or 'drop', got {unseen!r}")
    out = df
    for i, c in enumerate(model.columns):
        if c not in out.columns:
            continue
        v, ix = f"__label_value_{i}", f"__label_index_{i}"
        m = model.labels.where(F.col("column") == c).select(F.col("value").alias(v), F.col("index").alias(ix))
        if model.small(c):
            m = F.broadcast(m)
        how = "left" if unseen == "index" else "inner"
        out = out.join(m, F.col(f"`{c}`").cast("string") == F.col(v), how)
        out = out.withColumn(c, F.coalesce(F.col(ix), F.lit(model.sizes.get(c, 0))).cast("double")).drop(v, ix)
    return out


def drop_unseen(df: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """``dropna`` over the encoded categoricals: with ``unseen="index"`` nothing is null,
    so this keeps every row (the index-n rows stay)."""
    return df.dropna(subset=[c for c in spec.categoricals if c in df.columns])


def encode_categoricals(train: DataFrame, val: DataFrame, spec: PanelSpec = RETAIL, unseen: str = "index",
                        broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> tuple[DataFrame, DataFrame, LabelModel]:
    """Fit on ``train``, apply to both; returns (train_encoded, val_encoded, model)."""
    model = fit_labels(train, spec, broadcast_limit=broadcast_limit)
    return apply_labels(train, model, "index"), apply_labels(val, model, unseen), model
