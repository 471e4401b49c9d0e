"""Small helpers over Spark's own file-system client (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below ``path``; empty if it is not there."""
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _fs(spark, source)
    _, to = _fs(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the final name, then move: readers see all of it or nothing."""
    beside = f"{path}._writing"
    fs, where = _fs(spark, beside)
    out = fs.create(where, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    move(spark, beside, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
