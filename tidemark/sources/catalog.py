"""Tables by path and by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files
from tidemark.sources.state import TableMissing


def load_or_fail(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table by path; a missing one raises ``TableMissing``."""
    if not files.exists(spark, path):
        raise TableMissing(path)
    return spark.read.parquet(path)


def create_empty(spark: SparkSession, schema: T.StructType, location: str) -> None:
    """An empty Parquet folder with the schema, unless something is there already."""
    if not files.exists(spark, location):
        spark.createDataFrame([], schema).write.parquet(location)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, partition_by: str | None = None,
) -> None:
    """Register a folder under a name with fixed columns, unless the name is taken."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} LOCATION '{location}'"
    )


def register(
    spark: SparkSession, name: str, location: str, schema: T.StructType | None = None, partition_by: str | None = None,
) -> None:
    """Point a name at a folder, whatever it pointed at before.

    With a schema the folder may be empty or not there yet: the name is an empty table then.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if schema is None:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    else:
        files.make_folder(spark, location)
        create_table(spark, name, schema, location, partition_by)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def overwrite_partitioned(df: DataFrame, location: str, by: str) -> None:
    """Full refresh of a folder partitioned by ``by``; a heavy value gets several files."""
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(location)


def overwrite_partitions(df: DataFrame, location: str, by: str) -> None:
    """Full refresh of a folder partitioned by ``by``, one value after another.

    Values that are still there are replaced, the folders of those that are not go afterwards:
    readers of the folder, by path or by name, never find it empty in between.
    """
    spark = df.sparkSession
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    before = []
    if files.list_names(spark, location):
        # One row per value: a date, a country.
        before = spark.read.schema(df.schema).parquet(location).select(by, folder.alias("folder")).distinct().collect()
    seen = Observation()
    df = df.observe(seen, F.collect_set(by).alias("values"), F.max(F.col(by).isNull()).alias("null"))
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(location)
    written = {*seen.get["values"], *([None] if seen.get["null"] else [])}
    for row in before:
        if row[by] not in written:
            files.delete(spark, f"{location}/{row['folder']}")


def synchronise(spark: SparkSession, names: Iterable[str]) -> None:
    """Let the catalog find the partitions that came and went below the names' folders."""
    for name in names:
        if spark.catalog.tableExists(name):
            refresh(spark, name)


def list_tables(spark: SparkSession, pattern: str = "*") -> list[str]:
    """Names in the current database that match a pattern such as ``mart_*``."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern) if not t.isTemporary)


def refresh(spark: SparkSession, name: str) -> None:
    """Have a name's files, and partitions, listed anew."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
