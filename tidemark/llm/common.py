"""What the operators share: tables, the shared folder, Arrow helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED = "tidemark.llm.shipped"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, whatever folder they start in.

    The archive lies in the driver's own temporary folder; Spark serves it to the
    executors like any ``--py-files`` archive.
    """
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that driver and executors share.

    It lies below ``spark.checkpoint.dir``; where a session sets none (tests, a
    laptop) below the warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one job: below one folder that all executors reach, deleted with it.

    What a job returns has to be ``stored`` outside before the folder goes.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.count = spark, shared_path(spark, purpose), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete(self.root)

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written once and read again."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, *tables: DataFrame) -> None:
        """Deletes kept tables nothing reads any more, and lets Spark drop the shuffle files of finished jobs."""
        for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
            self.delete(path)
        self.spark.sparkContext._jvm.System.gc()

    def delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def set_aside(df: DataFrame, used: list[str], **made: Column) -> tuple[DataFrame, list[Column]]:
    """The columns in use, those made of the others, and all others in one struct ``aside``, where no name can
    clash with an operator's own; and how to get the columns of ``df`` back."""
    rest = [c for c in df.columns if c not in used]
    aside = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None)
    back = [F.col(f"aside.`{c}`").alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns]
    return df.select(*used, *[c.alias(name) for name, c in made.items()], aside.alias("aside")), back


#: Entries at most in a broadcast table of keys that stand out; rows of a key that are no burden to a task.
HOT, FEW = 20_000, 1_000


def looked_up(rows: DataFrame, known: DataFrame, keys: list[str], total: int, count: str = "n") -> DataFrame:
    """``rows`` joined with ``known``, whose keys are unique and whose ``count`` tells how many of ``total`` rows have that key.

    At most HOT keys can have more than ``total`` / HOT rows: they are broadcast. No task of the
    shuffle gets a key with more.
    """
    above = max(total // HOT, FEW)
    hot = F.broadcast(known.where(F.col(count) > above))
    rest = rows.join(hot.select(keys), keys, "left_anti").join(known.where(F.col(count) <= above), keys)
    return rows.join(hot, keys).unionByName(rest)


def small_batches(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``limit`` bytes, so that what is made of its texts stays small."""
    rows = max(1, min(batch.num_rows, batch.num_rows * limit // max(1, batch.get_total_buffer_size())))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All batches in small pieces; empty ones are left out."""
    for batch in batches:
        yield from small_batches(batch)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch per small piece of an input batch."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if (out := work(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as strings; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]
