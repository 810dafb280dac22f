"""Reading raw panels and writing / reading model matrices."""

from __future__ import annotations

import csv
import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfcast.sources import files
from shelfcast.spec import RAW_COLUMN_ORDER, RETAIL, PanelSpec

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMN_ORDER])


def raw_schema(columns=RAW_COLUMN_ORDER) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def matrix_schema(spec: PanelSpec = RETAIL) -> StructType:
    """Target first, then the 29 features, all doubles (headerless matrix files)."""
    return StructType([StructField(c, DoubleType(), True) for c in spec.output_cols])


def header_layouts(spark: SparkSession, paths: list[str], columns=RAW_COLUMN_ORDER) -> dict[tuple[str, ...], list[str]]:
    """Column order -> the files that have it, from the header line of every non-empty file.

    One light text scan finds the header lines (those that hold every needed name). A file
    without one fails here, by name, instead of being read into the wrong columns.
    """
    named = F.lit(True)
    for c in columns:
        named = named & F.col("value").contains(c)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    per_file = lines.groupBy("file").agg(F.min(F.when(named, F.col("value"))).alias("header"), F.max(F.length("value")).alias("longest"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    missing = []
    for row in per_file.collect():  # one row a file, as many as Spark's own file listing holds
        names = tuple(next(csv.reader([row["header"].lstrip("\ufeff")]))) if row["header"] else ()
        if set(columns) <= set(names):
            layouts.setdefault(names, []).append(unquote(row["file"]))
        elif row["longest"]:
            missing.append(row["file"])
    if missing:
        raise ValueError(f"no header with all of {list(columns)} in {sorted(missing)[:5]}")
    return layouts


def read_panel(spark: SparkSession, path: str | list[str], columns=RAW_COLUMN_ORDER) -> DataFrame:
    """Header CSV files at ``path`` (or paths); every column is text, empty fields are null.

    Columns are taken by header name, whatever their order in each file; extra columns are
    left out, and a file that lacks a needed one fails. Files of one layout are read together,
    with their headers checked again (``enforceSchema=false``).
    """
    layouts = header_layouts(spark, [path] if isinstance(path, str) else list(path), columns)
    out = spark.createDataFrame([], raw_schema(columns))
    parts = [spark.read.schema(raw_schema(names)).option("header", True).option("enforceSchema", False)
             .option("mode", "PERMISSIVE").csv(sorted(files)).select(*[F.col(f"`{c}`") for c in columns])
             for names, files in sorted(layouts.items())]
    for i, part in enumerate(parts):
        out = part if i == 0 else out.unionAll(part)
    return out


#: Written last, so a folder that has it is whole; readers of tables skip names that begin with ``_``.
MANIFEST = "_manifest.json"


def write_matrix(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False, ordered: bool = False) -> None:
    """Overwrite ``path`` with the matrix: headerless CSV (target first) or Parquet, and its manifest: files and
    their bytes, rows (counted by the write itself), columns and format.

    ``single_file`` funnels everything through one task; keep it off for large outputs.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"fmt must be 'csv' or 'parquet', got {fmt!r}")
    spark, seen = df.sparkSession, Observation()
    # repartition, not coalesce: only the write is single and the work above stays parallel;
    # but a sorted frame (``ordered``) keeps its order through coalesce alone
    out = (df.coalesce(1) if ordered else df.repartition(1)) if single_file else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", False).csv(path)
    else:
        writer.parquet(path)
    held = {"format": fmt, "columns": df.columns, "rows": seen.get["rows"], "files": files.data_files(spark, path)}
    files.write_text(spark, f"{path.rstrip('/')}/{MANIFEST}", json.dumps(held, sort_keys=True))


def check_matrix(spark: SparkSession, path: str, fmt: str | None = None) -> dict:
    """The manifest of a matrix folder, if the folder holds what it names; a ``ValueError`` says what is amiss."""
    base = path.rstrip("/")
    if not files.exists(spark, f"{base}/{MANIFEST}"):
        raise ValueError(f"{base}: no {MANIFEST}, so the write did not finish (or the files come from elsewhere: read them with check=False)")
    held = json.loads(files.read_text(spark, f"{base}/{MANIFEST}"))
    there = files.data_files(spark, base)
    wrong = [f"{name} is missing" for name in sorted(held["files"].keys() - there.keys())]
    wrong += [f"{name} is not of this matrix" for name in sorted(there.keys() - held["files"].keys())]
    wrong += [f"{name} has {there[name]} bytes instead of {n}" for name, n in sorted(held["files"].items()) if name in there and there[name] != n]
    if fmt and held["format"] != fmt:
        wrong.append(f"it is {held['format']}, not {fmt}")
    if wrong:
        raise ValueError(f"{base}: incomplete matrix: {'; '.join(wrong[:5])}" + (f" and {len(wrong) - 5} more" if len(wrong) > 5 else ""))
    return held


def write_matrices(train: DataFrame, validation: DataFrame, base: str, fmt: str = "csv",
                   single_file: bool = False, ordered: bool = False) -> tuple[str, str]:
    base = base.rstrip("/")
    train_path, val_path = f"{base}/train/", f"{base}/validation/"
    write_matrix(train, train_path, fmt, single_file, ordered)
    write_matrix(validation, val_path, fmt, single_file, ordered)
    return train_path, val_path


def read_matrix(spark: SparkSession, path: str, spec: PanelSpec = RETAIL, fmt: str = "csv", check: bool = True) -> DataFrame:
    """Inverse of ``write_matrix``: target-first matrix files as doubles. A folder whose write did not finish, or that has
    lost or gained files since, is refused; ``check=False`` reads matrix files made elsewhere."""
    if check:
        check_matrix(spark, path, fmt)
    if fmt == "csv":
        return spark.read.schema(matrix_schema(spec)).option("header", False).csv(path)
    return spark.read.parquet(path)
