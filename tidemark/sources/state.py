"""Tables of current rows: plain Parquet, partitioned by a hash of the key.

    <root>/rows_N/bucket=B/part-*.parquet      N buckets

A write replaces the buckets its keys fall into, by Spark's dynamic partition overwrite, so
the cost of a micro-batch follows its keys and not the table. Each bucket also holds notes,
rows without key that say up to which batch of which stream it is (``commit``: up to which
change rows); they are replaced together with the rows, so a replay finds per bucket what is
done. One writer per table; how sharp the moment of replacement is depends on the storage.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dml import insert_changes, insert_rows, update_changes, update_where
from tidemark.sources import files
from tidemark.sources.change_log import ChangeLog

NOTES = T.StructType([T.StructField("_stream", T.StringType()), T.StructField("_batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
COMMIT = "commit"


class TableMissing(Exception):
    """There is no table where one was expected."""

    exit_code = 2


@dataclass(frozen=True)
class StateTable:
    """``buckets`` is fixed for the life of a table; size it so that a bucket holds a few gigabytes at most.

    ``sort_by`` orders the rows of a file, so that readers skip by its statistics. ``hidden``
    columns and the rows that don't meet ``live`` (tombstones) are for writers only.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 16
    sort_by: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()
    live: str | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/rows_{self.buckets}"

    @property
    def log(self) -> ChangeLog:
        """The change rows of the table's writes, where they are kept."""
        return ChangeLog(self.spark, f"{self.root}/changes", T.StructType([f for f in self.schema.fields if f.name not in self.hidden]))

    def exists(self) -> bool:
        names = [n for n in files.list_names(self.spark, self.root) if n.startswith("rows_")]
        if names and names != [f"rows_{self.buckets}"]:
            raise ValueError(f"{self.root} has {names[0][5:]} buckets, not {self.buckets}")
        return bool(names)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched_buckets(self, rows: DataFrame) -> list[int]:
        """Buckets the rows' keys fall into: at most ``buckets`` small integers."""
        return [r[0] for r in rows.select(self.bucket_of().alias("b")).distinct().collect()]

    # --- reading --------------------------------------------------------------

    def everything(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows and notes, of some buckets only if named; the files are those of this moment."""
        schema = T.StructType(self.schema.fields + NOTES.fields)
        if not self.exists():
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))

    def visible(self, rows: DataFrame) -> DataFrame:
        rows = rows.where("_stream IS NULL").select(*self.schema.fieldNames())
        return (rows.where(self.live) if self.live else rows).drop(*self.hidden)

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.visible(self.everything(buckets))

    def read_state(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The same with hidden columns and tombstones, as writers need it."""
        return self.everything(buckets).where("_stream IS NULL").select(*self.schema.fieldNames())

    def notes(self, rows: DataFrame) -> DataFrame:
        """(bucket, _stream, _batch): how far each bucket is with each stream."""
        return rows.where("_stream IS NOT NULL").groupBy("bucket", "_stream").agg(F.max("_batch").alias("_batch"))

    def pending(self, rows: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """The rows whose buckets don't hold that micro-batch of the stream yet."""
        done = self.notes(self.everything()).where((F.col("_stream") == stream) & (F.col("_batch") >= batch_id)).select(F.col("bucket").alias("_done"))
        return rows.join(F.broadcast(done), self.bucket_of() == F.col("_done"), "left_anti")  # one row per bucket at most

    # --- writing --------------------------------------------------------------

    def _placed(self, rows: DataFrame, touched: Sequence[int], stream: str, batch_id: int) -> DataFrame:
        """Rows as stored, and a note for every touched bucket, which so is replaced even if it runs empty."""
        bucket = self.bucket_of()
        allowed = F.when(bucket.isin(list(touched)), bucket).otherwise(F.raise_error(F.lit("rows of a bucket that was not read")).cast("int"))
        hidden = {f.name: F.lit(None).cast(f.dataType) for f in self.schema.fields if f.name in self.hidden and f.name not in rows.columns}
        kept = rows.withColumns(hidden).select(*self.schema.fieldNames()).withColumns({"_stream": F.lit(None).cast("string"), "_batch": F.lit(None).cast("bigint")})
        noted = self.spark.createDataFrame([(stream, batch_id, b) for b in touched], NOTES)
        return kept.withColumn("bucket", allowed).unionByName(noted, allowMissingColumns=True)

    def write(self, rows: DataFrame, touched: Sequence[int] | None = None, stream: str = "write", batch_id: int = 0) -> None:
        """Make ``rows`` the content of the touched buckets (None: of all).

        AQE splits a heavy bucket over several files and packs light ones together.
        """
        touched = list(range(self.buckets) if touched is None else touched)
        before = self.notes(self.everything(touched)).where(F.col("_stream") != stream)
        placed = self._placed(rows, touched, stream, batch_id).unionByName(before, allowMissingColumns=True)
        placed = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.sort_by)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def insert(self, rows: DataFrame) -> None:
        """Append rows, by name, as further files; keys are not checked for repeats."""
        typed = insert_rows(self.spark.createDataFrame([], self.schema).drop(*self.hidden), rows)
        self.exists()
        commit = self.log.append(insert_changes(typed))
        placed = self._placed(typed, self.touched_buckets(typed), COMMIT, commit).hint("rebalance", "bucket")
        placed.write.mode("append").partitionBy("bucket").parquet(self.path)

    def update(self, condition: str, assignments: dict[str, str]) -> None:
        """Change columns of the rows that meet a SQL condition; keys must not change."""
        if moved := set(assignments) & set(self.keys):
            raise ValueError(f"an update can't change key columns: {sorted(moved)}")
        touched = self.touched_buckets(self.read().where(condition))
        commit = self.log.append(update_changes(self.read(touched), condition, assignments))
        met = f"({condition}) AND ({self.live})" if self.live else condition
        self.write(update_where(self.read_state(touched), met, assignments), touched, COMMIT, commit)
