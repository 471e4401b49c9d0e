"""The streaming jobs of a lakehouse folder.

Each job is a thin shell: read a stream, hand every micro-batch to the batch operators,
write the buckets it touched. Replays and restarts are safe for all of them: merges
end at the same rows, change rows are there already, and the buckets of the additive
daily counts know which micro-batch they hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.rules import customer_rule, order_rule, split_valid
from tidemark.functions.scalars import change_sign
from tidemark.operators.changefeed import GROUP, deltas, merge_deltas
from tidemark.operators.reconcile import daily_counts
from tidemark.operators.merge import Merged
from tidemark.operators.scd2 import OPENS, history_merge, scd2_batch, slice_for
from tidemark.plans import marts, tables
from tidemark.schemas import (
    AGG_ORDERS_DAILY, BRONZE, DIM_CUSTOMERS, FACT_STATE, HISTORY_STATE, MART_DAILY_ORDERS, MART_ORDERS_BY_STATE,
    ORDERS_ENRICHED, POSITION, SILVER_STATE,
)
from tidemark.sources import files
from tidemark.sources.bronze import LOG_CODEC, CdcSource, project_bronze, read_bronze, read_bronze_stream, read_cdc_stream
from tidemark.sources.catalog import overwrite_partitions, register, synchronise
from tidemark.sources.reports import quarantine
from tidemark.sources.state import COMMIT, StateTable

# Files one micro-batch may take, unless a job is told otherwise: a first start on a
# long log must not become a single batch. Only jobs whose result does not depend on the
# cut are paced; a dimension with one version per key and micro-batch takes what is there.
FILES_PER_BATCH = "1000"
BRONZE_INTERVAL = "15 seconds"  # fixed value: how often the log is extended
# Topics a task of the bronze job keeps a file open for, so that its rows need no sort by topic
# (which spills); a task that meets more sorts the rest.
OPEN_TOPICS = "8"

Work = Callable[[DataFrame, str, int], None]
MARTS = {"mart_daily_orders": MART_DAILY_ORDERS, "mart_orders_by_state": MART_ORDERS_BY_STATE}


def _paced(options: dict[str, str]) -> dict[str, str]:
    return {"maxFilesPerTrigger": FILES_PER_BATCH, **options}


@dataclass(frozen=True)
class Lakehouse:
    """All tables and jobs below one absolute root folder.

    ``tz`` is the zone whose calendar day dates an order. With the default guard the
    latest event in stream order wins, however files are cut into micro-batches and in
    whatever order they come; deletes are kept as tombstones for that.
    ``guard="event_time"`` compares event times only and keeps no tombstones, ``None``
    lets the later micro-batch win; both need files in order.
    ``once=True`` on a job works off what is there and stops; otherwise the job
    runs until it is stopped.
    """

    spark: SparkSession
    root: str
    prefix: str = "shop"
    tz: str | None = "UTC"
    buckets: int = 1024
    guard: str | None = "order"

    def __post_init__(self) -> None:
        if not (self.root.startswith("/") or "://" in self.root or ":/" in self.root):
            raise ValueError("the root must be absolute: a relative path depends on where a job starts")

    # --- tables ---------------------------------------------------------------

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze"

    def _table(self, name: str, schema, *keys: str, **kw) -> StateTable:
        return StateTable(self.spark, f"{self.root}/{name}", schema, keys, self.buckets, **kw)

    @property
    def silver(self) -> StateTable:
        return self._table("silver_customers", SILVER_STATE, "customer_id", hidden=tables.HIDDEN, live=tables.LIVE)

    @property
    def dim(self) -> StateTable:
        return self._table("dim_customers", DIM_CUSTOMERS, "customer_id")

    @property
    def history(self) -> StateTable:
        """The dimension with every change, kept by event time."""
        return self._table("customer_history", HISTORY_STATE, "customer_id", hidden=(*POSITION.fieldNames(), OPENS), live=OPENS)

    @property
    def fact(self) -> StateTable:
        return self._table("fact_orders", FACT_STATE, "order_id", sort_by=("event_date",), hidden=tables.HIDDEN, live=tables.LIVE)

    @property
    def agg(self) -> StateTable:
        return self._table("agg_orders_daily", AGG_ORDERS_DAILY, "event_date", "order_status")

    @property
    def enriched(self) -> StateTable:
        return self._table("orders_enriched", ORDERS_ENRICHED, "order_id")

    def mart(self, name: str) -> DataFrame:
        """A mart's rows as last built."""
        folder = f"{self.root}/{name}"
        if not files.list_names(self.spark, folder):
            return self.spark.createDataFrame([], MARTS[name])
        return self.spark.read.schema(MARTS[name]).parquet(folder).select(*MARTS[name].fieldNames())

    # --- plumbing ---------------------------------------------------------------

    def _checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def _start(self, writer: DataStreamWriter, job: str, once: bool, every: str | None = None) -> StreamingQuery:
        writer = writer.queryName(job).option("checkpointLocation", self._checkpoint(job))
        if once:
            writer = writer.trigger(availableNow=True)
        elif every:
            writer = writer.trigger(processingTime=every)
        return writer.start()

    def _stream_id(self, job: str) -> str:
        """The id Spark gave the query in its checkpoint; a new checkpoint is a new stream."""
        metadata = files.read_text(self.spark, f"{self._checkpoint(job)}/metadata")
        return f"{job}:{json.loads(metadata)['id']}"

    def _each_batch(self, job: str, work: Work, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
        """``keep`` cuts a batch down to what ``work`` needs of it, before it is held."""
        def run(batch: DataFrame, batch_id: int) -> None:
            # In the stream's own session: what is held of a shuffle is packed together like any other.
            batch.sparkSession.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
            # Several actions read the batch; parse it once. Lost blocks are recomputed.
            batch = keep(batch).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                work(batch, self._stream_id(job), batch_id)
            finally:
                batch.unpersist()

        return run

    def _bronze_stream(self, options: dict[str, str], paced: bool = True) -> DataFrame:
        files.make_folder(self.spark, self.bronze_path)
        return read_bronze_stream(self.spark, self.bronze_path, **(_paced(options) if paced else options))

    # --- jobs -------------------------------------------------------------------

    def start_bronze(self, source: CdcSource, once: bool = False) -> StreamingQuery:
        """Append raw events to the log, one folder per topic.

        Runs in a session of its own, for a setting that other writes of this one need not have.
        """
        session = self.spark.newSession()
        for name, value in self.spark.conf.getAll.items():
            if session.conf.isModifiable(name):
                session.conf.set(name, value)
        session.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_TOPICS)
        rows = project_bronze(read_cdc_stream(session, source))
        writer = (
            rows.writeStream.format("parquet").outputMode("append").option("compression", LOG_CODEC)
            .option("path", self.bronze_path).partitionBy("topic")
        )
        return self._start(writer, "bronze", once, BRONZE_INTERVAL)

    def bronze(self) -> DataFrame:
        if not files.exists(self.spark, self.bronze_path):
            return self.spark.createDataFrame([], BRONZE)
        return read_bronze(self.spark, self.bronze_path)

    def start_silver(self, once: bool = False, **options: str) -> StreamingQuery:
        table = self.silver

        def work(batch: DataFrame, stream: str, batch_id: int) -> None:
            valid, rejected = split_valid(batch, customer_rule())
            quarantine(rejected, f"{self.root}/quarantine/customers", stream, batch_id)
            touched = table.touched_buckets(valid)
            if touched:
                if self.guard == "order":
                    merged = tables.silver_merge_ordered(table.read_state(touched), valid, unique=True)
                else:
                    merged = tables.silver_merge(table.read(touched), valid, self.guard)
                table.write(merged.rows(), touched, stream, batch_id)

        events = tables.customer_events(self._bronze_stream(options), self.prefix)
        writer = events.writeStream.foreachBatch(self._each_batch("silver_customers", work, tables.silver_batch))
        return self._start(writer, "silver_customers", once)

    def _start_versions(self, job: str, table: StateTable, merge: Callable[[DataFrame, DataFrame], DataFrame], once: bool, rows: DataFrame) -> StreamingQuery:
        def work(batch: DataFrame, stream: str, batch_id: int) -> None:
            valid, rejected = split_valid(batch, customer_rule())
            quarantine(rejected, f"{self.root}/quarantine/{job}", stream, batch_id)
            touched = table.touched_buckets(valid)
            if touched:
                table.write(merge(table.read_state(touched), valid), touched, stream, batch_id)

        events = tables.keyed(tables.customer_events(rows, self.prefix))
        return self._start(events.writeStream.foreachBatch(self._each_batch(job, work)), job, once)

    def start_dim(self, once: bool = False, **options: str) -> StreamingQuery:
        """One version per key and micro-batch, in the order in which micro-batches come."""
        return self._start_versions("dim_customers", self.dim, scd2_batch, once, self._bronze_stream(options, paced=False))

    def start_history(self, once: bool = False, **options: str) -> StreamingQuery:
        """Every change by event time: late events find their place, and no cut into micro-batches shows."""
        def merge(state: DataFrame, valid: DataFrame) -> DataFrame:
            return history_merge(state, valid, slice_ms=slice_for(state, valid))

        return self._start_versions("customer_history", self.history, merge, once, self._bronze_stream(options))

    def start_fact(self, once: bool = False, **options: str) -> StreamingQuery:
        def work(batch: DataFrame, stream: str, batch_id: int) -> None:
            table = replace(self.fact, spark=batch.sparkSession)  # the merge is held under the stream's settings, too
            valid, rejected = split_valid(batch, order_rule())
            quarantine(rejected, f"{self.root}/quarantine/fact_orders", stream, batch_id)
            touched = table.touched_buckets(valid)
            if touched:
                if self.guard == "order":
                    merged = tables.fact_merge_ordered(table.read_state(touched), valid, unique=True)
                else:
                    merged = tables.fact_merge(table.read(touched), valid, self.guard)
                self._write_with_changes(table, merged, touched, stream, batch_id)

        events = tables.order_events(self._bronze_stream(options), self.prefix, self.tz)
        writer = events.writeStream.foreachBatch(self._each_batch("fact_orders", work, tables.fact_batch))
        return self._start(writer, "fact_orders", once)

    def _write_with_changes(self, table: StateTable, merged: Merged, touched: list[int], stream: str, batch_id: int) -> None:
        """Change rows first, then the buckets, which note their number; one join gives both."""
        merged = merged.persist()
        try:
            commit = table.log.append(merged.changes(), stream, batch_id)
            table.write(merged.rows(), touched, COMMIT, commit)
        finally:
            merged.joined.unpersist()

    # --- daily counts -----------------------------------------------------------

    def _count_fact(self) -> dict[int, int]:
        """Recount the fact into the daily counts; gives up to which change rows each bucket was counted.

        Rows and notes come from the same files, so a writer at work meanwhile does no harm.
        """
        fact, state = self.fact, self.fact.everything()
        self.agg.write(daily_counts(fact.visible(state)), stream="seed")
        return {r["bucket"]: r["_batch"] for r in fact.notes(state).where(F.col("_stream") == COMMIT).collect()}

    def _first_changes(self, job: str, start: str) -> dict[int, int]:
        """Per bucket of the fact the last change rows the count job leaves out; kept, so a restart does not move it."""
        if start not in ("snapshot", "next"):
            raise ValueError(f"unknown start {start!r}")
        note = f"{self.root}/checkpoints/{job}.start"
        if not files.exists(self.spark, note):
            seen = self._count_fact() if start == "snapshot" else dict.fromkeys(range(self.buckets), self.fact.log.last_commit())
            files.write_text(self.spark, note, json.dumps(seen))
        return {int(b): c for b, c in json.loads(files.read_text(self.spark, note)).items()}

    def seed_agg(self) -> None:
        """Recount the fact into the daily counts; ``start_agg`` goes on from there at its first start."""
        files.write_text(self.spark, f"{self.root}/checkpoints/agg_orders_daily.start", json.dumps(self._count_fact()))

    def start_agg(self, once: bool = False, start: str = "snapshot", **options: str) -> StreamingQuery:
        """Keep the daily counts up from the fact's change rows.

        The first start with ``start="snapshot"`` counts the fact's current rows, whether or
        not change rows are kept of them, and then takes what changed after; ``"next"`` takes
        only what changes from now on (or since ``seed_agg``).
        """
        table, job = self.agg, "agg_orders_daily"
        seen = self._first_changes(job, start)
        changes = self.fact.log.stream(**_paced(options))
        if seen:
            counted = F.create_map(*[F.lit(x).cast("bigint") for pair in seen.items() for x in pair])
            last = F.try_element_at(counted, self.fact.bucket_of().cast("bigint"))
            changes = changes.where(F.col("_commit_version") > F.coalesce(last, F.lit(-1)))

        def work(batch: DataFrame, stream: str, batch_id: int) -> None:
            delta = table.pending(batch, stream, batch_id).persist()
            try:
                touched = table.touched_buckets(delta)
                if touched:
                    table.write(merge_deltas(table.read(touched), delta).rows(), touched, stream, batch_id)
            finally:
                delta.unpersist()

        writer = changes.writeStream.foreachBatch(self._each_batch(job, work, deltas))
        return self._start(writer, job, once)

    def start_agg_native(self, sink: Callable[[DataFrame, int], None], once: bool = False,
                         **options: str) -> StreamingQuery:
        """The same counts in Spark's state store, from the first change row on: every trigger hands
        the groups that changed, with their totals so far, to ``sink``."""
        changes = self.fact.log.stream(**_paced(options))
        totals = changes.groupBy(*GROUP).agg(F.sum(change_sign(F.col("_change_type"))).alias("order_cnt"))
        writer = totals.writeStream.outputMode("update").foreachBatch(sink)
        return self._start(writer, "agg_orders_daily_native", once)

    # --- batch refreshes ----------------------------------------------------------

    def build_mart(self, name: str = "mart_daily_orders", register_as: str | None = None) -> None:
        """Full refresh of a mart, date by date, in one folder; names it was given keep up with it."""
        folder, schema = f"{self.root}/{name}", MARTS[name]
        rows = getattr(marts, name)(self.fact.read(), self.dim.read())
        overwrite_partitions(rows.select(*schema.fieldNames()), folder, "event_date")
        note = f"{self.root}/{name}.names"
        names = json.loads(files.read_text(self.spark, note)) if files.exists(self.spark, note) else []
        if register_as:
            register(self.spark, register_as, folder, schema, "event_date")
            files.write_text(self.spark, note, json.dumps(sorted({*names, register_as})))
        synchronise(self.spark, names)

    def backfill_enriched(self) -> None:
        """Upsert every order of the fact with its customer's current place."""
        merged = marts.orders_enriched_merge(
            self.enriched.read(), marts.enrich_orders(self.fact.read(), self.dim.read()),
        )
        self.enriched.write(merged.rows())
