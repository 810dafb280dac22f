"""Folders of a table store, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none for a folder that is not there. Other faults, such as a missing
    permission, are raised."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files below a folder and their bytes, by path relative to it, without those that readers skip."""
    out: dict[str, int] = {}
    for name in children(spark, path):
        if name[0] in "._":
            continue
        fs, p = _path(spark, f"{path}/{name}")
        status = fs.getFileStatus(p)
        if status.isDirectory():
            out |= {f"{name}/{k}": v for k, v in data_files(spark, f"{path}/{name}").items()}
        else:
            out[name] = status.getLen()
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that this library wrote; nothing if it is not there."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text into one file; it appears whole or not at all (written beside, then renamed)."""
    fs, p = _path(spark, path)
    _, beside = _path(spark, f"{p.getParent()}/.{p.getName()}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"cannot rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
