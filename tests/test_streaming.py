"""Jobs run as real streams: same tables as the set-wise plans, safe to restart."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidemark.functions.rules import customer_rule, order_rule, split_valid
from tidemark.operators.reconcile import daily_counts, reconcile
from tidemark.operators.scd2 import history_state, scd2_history
from tidemark.plans import tables
from tidemark.schemas import CUSTOMERS, KAFKA, ORDERS
from tidemark.sources import replay
from tidemark.sources.bronze import CdcSource
from tidemark.streaming.jobs import Lakehouse

BATCHES = 4


def land(spark, folder, sf_dir, first, last):
    """One landing file per micro-batch, in the row shape of a Kafka reader."""
    log = replay.kafka_log(spark, sf_dir, CUSTOMERS, ORDERS)
    for n in range(first, last):
        part = log.where((F.col("offset") >= n * 1000) & (F.col("offset") < (n + 1) * 1000))
        part.coalesce(1).write.mode("append").parquet(folder)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def run_all(house, source, start="snapshot"):
    run(house.start_bronze(source, once=True))
    for job in (house.start_silver, house.start_dim, house.start_history, house.start_fact):
        run(job(once=True, maxFilesPerTrigger="1"))
    run(house.start_agg(once=True, start=start, maxFilesPerTrigger="1"))


@pytest.fixture(scope="module")
def house(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    landing = f"{root}/landing"
    house = Lakehouse(spark, root, buckets=4)
    source = CdcSource("files", path=landing, options={"maxFilesPerTrigger": "1"})
    land(spark, landing, sf_dir, 0, 2)
    run_all(house, source)
    land(spark, landing, sf_dir, 2, BATCHES)  # second start: restart from the checkpoints
    run_all(house, source)
    return house


def expected(spark, sf_dir):
    log = replay.bronze(spark, sf_dir, CUSTOMERS, ORDERS).where(F.col("kafka_offset") < BATCHES * 1000)
    customers = split_valid(tables.customer_events(log), customer_rule())
    orders = split_valid(tables.order_events(log), order_rule())
    return customers, orders


def test_bronze_holds_every_event_once(house):
    counts = house.bronze().groupBy("topic").agg(
        F.count("*").alias("n"), F.count_distinct("kafka_offset").alias("d"),
    )
    assert rows(counts, "topic", "n", "d") == [
        ("shop.public.customers", BATCHES * 1000, BATCHES * 1000),
        ("shop.public.orders", BATCHES * 1000, BATCHES * 1000),
    ]


def test_silver_equals_set_wise(spark, sf_dir, house):
    (valid, rejected), _ = expected(spark, sf_dir)
    assert rows(house.silver.read()) == rows(tables.silver_state(valid))
    kept = spark.read.json(f"{house.root}/quarantine/customers")
    assert kept.count() == rejected.count()


def test_dim_equals_set_wise(spark, sf_dir, house):
    (valid, _), _ = expected(spark, sf_dir)
    batched = valid.withColumn("batch_no", replay.batch_no())
    assert rows(house.dim.read()) == rows(scd2_history(batched, "batch_no"))


def test_history_equals_every_event_in_order(spark, sf_dir, house):
    (valid, _), _ = expected(spark, sf_dir)
    fresh = valid.withColumns({"_partition": F.col("kafka_partition"), "_offset": F.col("kafka_offset")})
    want = history_state(fresh, slice_ms=None).where("_opens").select(house.history.read().columns)
    assert rows(house.history.read()) == rows(want)


def test_fact_and_changes_equal_set_wise(spark, sf_dir, house):
    _, (valid, _) = expected(spark, sf_dir)
    assert rows(house.fact.read()) == rows(tables.fact_state(valid))
    history = tables.fact_changes(valid.withColumn("batch_no", replay.batch_no()), "batch_no")
    # Commits count written batches, batch numbers the fixture's; both start at 0 here.
    assert rows(house.fact.log.read()) == rows(history)


def test_counts_reconcile(spark, house):
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()
    assert rows(house.agg.read().where("order_cnt <> 0")) == rows(daily_counts(house.fact.read()))


def test_restart_without_news_changes_nothing(house):
    def seen():
        every = (house.silver, house.dim, house.history, house.fact, house.agg)
        return [rows(t.everything()) for t in every], [sorted(t.everything().inputFiles()) for t in every]

    before = seen()
    for job in (house.start_silver, house.start_dim, house.start_history, house.start_fact, house.start_agg):
        run(job(once=True))
    assert before == seen()


def test_lost_commit_is_replayed_as_a_no_op(spark, house):
    """The stream forgets its last commits (crash after publishing): same tables."""
    import os

    before = rows(house.agg.read()), rows(house.fact.log.read())
    for job, start in (("fact_orders", house.start_fact), ("agg_orders_daily", house.start_agg)):
        commits = f"{house.root}/checkpoints/{job}/commits"
        last = max(int(n) for n in os.listdir(commits) if n.isdigit())
        os.remove(f"{commits}/{last}")
        crc = f"{commits}/.{last}.crc"
        if os.path.exists(crc):
            os.remove(crc)
        run(start(once=True))
    assert before == (rows(house.agg.read()), rows(house.fact.log.read()))


def test_native_counts_equal(spark, house):
    """The state store gives the same totals as the merged table."""
    out = f"{house.root}/native"

    def sink(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/{batch_id}")

    run(house.start_agg_native(sink, once=True, maxFilesPerTrigger="2"))
    seen = spark.read.option("recursiveFileLookup", "true").parquet(out)
    last = seen.groupBy("event_date", "order_status").agg(F.max_by("order_cnt", "batch_id").alias("order_cnt"))
    assert rows(last.where("order_cnt <> 0")) == rows(house.agg.read().where("order_cnt <> 0"))


def test_marts_and_enriched(spark, house):
    house.build_mart("mart_daily_orders")
    house.build_mart("mart_orders_by_state", register_as="by_state")
    daily, by_state = house.mart("mart_daily_orders"), house.mart("mart_orders_by_state")
    total = house.fact.read().count()
    assert daily.agg(F.sum("order_count")).first()[0] == total
    assert by_state.agg(F.sum("orders_cnt")).first()[0] == total
    assert rows(spark.table("by_state"), "event_date", "customer_state", "orders_cnt") == rows(
        by_state, "event_date", "customer_state", "orders_cnt",
    )
    house.backfill_enriched()
    house.backfill_enriched()
    assert house.enriched.read().count() == total


def test_seeded_counts_take_only_later_changes(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    house = Lakehouse(spark, root, buckets=2)
    source = CdcSource("files", path=f"{root}/landing", options={"maxFilesPerTrigger": "1"})
    land(spark, f"{root}/landing", sf_dir, 0, 1)
    run(house.start_bronze(source, once=True))
    run(house.start_fact(once=True))
    house.seed_agg()
    run(house.start_agg(once=True, start="next"))
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()
    land(spark, f"{root}/landing", sf_dir, 1, 2)
    run(house.start_bronze(source, once=True))
    run(house.start_fact(once=True))
    run(house.start_agg(once=True, start="next"))
    assert house.fact.log.last_commit() == 1
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()


def event(op, ts, key, state="SP", city="x"):
    image = {"customer_id": key, "customer_unique_id": "u", "customer_city": city, "customer_state": state}
    before, after = (image, None) if op == "d" else (None, image)
    return json.dumps({"op": op, "ts_ms": ts, "before": before, "after": after})


def put(spark, folder, offset, *values):
    data = [
        (None, v.encode(), "shop.public.customers", 0, offset + i, None, 0) for i, v in enumerate(values)
    ]
    spark.createDataFrame(data, T.StructType(KAFKA.fields)).coalesce(1).write.mode("append").parquet(folder)


def test_batches_that_open_nothing(spark, tmp_path):
    """Delete-only, no-change and all-invalid micro-batches pass without error."""
    root = str(tmp_path)
    house = Lakehouse(spark, root, buckets=2)
    source = CdcSource("files", path=f"{root}/landing")

    def feed(offset, *values):
        put(spark, f"{root}/landing", offset, *values)
        run(house.start_bronze(source, once=True))
        run(house.start_silver(once=True))
        run(house.start_dim(once=True))

    feed(0, event("c", 10, "a"), event("c", 10, "b"))
    feed(10, event("u", 20, "a"))
    assert house.dim.read().count() == 2
    feed(20, event("d", 30, "a"), event("d", 30, "nobody"))
    assert rows(house.dim.read(), "customer_id", "effective_end_ts_ms", "is_current") == [
        ("a", 30, False), ("b", None, True),
    ]
    assert rows(house.silver.read(), "customer_id") == [("b",)]
    feed(30, event("c", 40, "b", state="XXX"), "not json")
    assert house.dim.read().count() == 2
    assert spark.read.json(f"{root}/quarantine/customers").count() == 2
    assert spark.read.json(f"{root}/quarantine/dim_customers").count() == 1
    feed(40, event("c", 50, "a", city="y"))
    assert rows(house.dim.read().where("is_current"), "customer_id", "customer_city") == [("a", "y"), ("b", "x")]


def test_guard_against_late_batches(spark, tmp_path):
    for guard, city in ((None, "late"), ("event_time", "now")):
        root = str(tmp_path / str(guard))
        house = Lakehouse(spark, root, buckets=2, guard=guard)
        source = CdcSource("files", path=f"{root}/landing")
        for offset, value in ((0, event("c", 100, "a", city="now")), (1, event("u", 50, "a", city="late"))):
            put(spark, f"{root}/landing", offset, value)
            run(house.start_bronze(source, once=True))
            run(house.start_silver(once=True))
        assert rows(house.silver.read(), "customer_city") == [(city,)]


def test_root_must_be_absolute(spark):
    with pytest.raises(ValueError):
        Lakehouse(spark, "data/lake")


@pytest.mark.parametrize("files_per_batch", ["1", "1000"])
def test_no_cut_into_batches_changes_silver_and_fact(spark, sf_dir, tmp_path, files_per_batch):
    """Files whose offsets interleave, the newest rows first: the result is that of one plan over the log."""
    root = str(tmp_path)
    house = Lakehouse(spark, root, buckets=2)
    log = replay.kafka_log(spark, sf_dir, CUSTOMERS, ORDERS).where("offset < 1500")
    for n in (2, 0, 1):
        log.where(f"offset % 3 = {n}").coalesce(1).write.mode("append").parquet(f"{root}/landing")
    run(house.start_bronze(CdcSource("files", path=f"{root}/landing"), once=True))
    run(house.start_silver(once=True, maxFilesPerTrigger=files_per_batch))
    run(house.start_fact(once=True, maxFilesPerTrigger=files_per_batch))
    log = replay.bronze(spark, sf_dir, CUSTOMERS, ORDERS).where("kafka_offset < 1500")
    customers = split_valid(tables.customer_events(log), customer_rule())[0]
    orders = split_valid(tables.order_events(log), order_rule())[0]
    assert rows(house.silver.read()) == rows(tables.silver_state(customers))
    assert rows(house.fact.read()) == rows(tables.fact_state(orders))
    assert rows(daily_counts(house.fact.read())) == rows(
        house.fact.log.read().groupBy("event_date", "order_status").agg(
            F.sum(F.expr("CASE WHEN _change_type IN ('insert', 'update_postimage') THEN 1 ELSE -1 END")).alias("order_cnt"),
        ).where("order_cnt <> 0"),
    )


def test_a_late_upsert_does_not_revive_a_deleted_row(spark, tmp_path):
    root = str(tmp_path)
    house = Lakehouse(spark, root, buckets=2)
    source = CdcSource("files", path=f"{root}/landing")
    for offset, value in ((5, event("d", 100, "a")), (1, event("c", 50, "a")), (9, event("c", 200, "b"))):
        put(spark, f"{root}/landing", offset, value)
        run(house.start_bronze(source, once=True))
        run(house.start_silver(once=True))
    assert rows(house.silver.read(), "customer_id") == [("b",)]


def test_rejects_are_stored_once(spark, tmp_path):
    """Replays, new checkpoints and offsets that come again add nothing; equal rows of other offsets, and rows without position, stay."""
    from tidemark.sources.reports import quarantine

    def batch(*rows_):
        return spark.createDataFrame(rows_, "op string, kafka_partition int, kafka_offset bigint")

    def seen():
        return rows(spark.read.schema("op string, kafka_partition int, kafka_offset bigint").json(root), "op", "kafka_partition", "kafka_offset")

    root, far = str(tmp_path / "rejects"), 5 << 20
    assert not quarantine(batch(("x", 0, 1)).limit(0), root, "job:a", 0)
    assert quarantine(batch(("x", 0, 1), ("x", 0, 2), ("y", 1, 1), ("y", 1, far)), root, "job:a", 0)
    want = [("x", 0, 1), ("x", 0, 2), ("y", 1, 1), ("y", 1, far)]
    assert seen() == want
    quarantine(batch(("x", 0, 1), ("x", 0, 2), ("y", 1, 1), ("y", 1, far)), root, "job:a", 0)
    quarantine(batch(("x", 0, 1), ("y", 1, far), ("z", 0, 3)), root, "job:b", 0)
    assert seen() == sorted([*want, ("z", 0, 3)], key=repr)
    quarantine(batch(("n", None, None), ("n", None, None)), root, "job:b", 1)
    assert len(seen()) == 7


def test_bronze_takes_mixed_topics_and_stores_them_small(spark, tmp_path):
    """Rows of more topics than a task keeps files open for, mixed in one file: each is there once, in the log's codec."""
    from tidemark.sources import files
    from tidemark.sources.bronze import LOG_CODEC

    root, before = str(tmp_path), spark.conf.getAll
    rows_ = [(b"k", f"v{n}".encode(), f"shop.public.t{n % 12}", 0, n) for n in range(600)]
    landed = spark.createDataFrame(rows_, "key binary, value binary, topic string, partition int, offset bigint")
    landed = landed.withColumns({"timestamp": F.current_timestamp(), "timestampType": F.lit(0)}).select(*KAFKA.fieldNames())
    landed.coalesce(1).write.parquet(f"{root}/landing")
    house = Lakehouse(spark, root, buckets=2)
    run(house.start_bronze(CdcSource("files", path=f"{root}/landing"), once=True))
    assert rows(house.bronze(), "kafka_offset", "topic", "v") == sorted([(n, t, v.decode()) for _, v, t, _, n in rows_], key=repr)
    for n in range(12):
        names = [x for x in files.list_names(spark, f"{house.bronze_path}/topic=shop.public.t{n}") if x.startswith("part-")]
        assert len(names) == 1 and f".{LOG_CODEC}." in names[0]
    assert spark.conf.getAll == before


def test_a_batch_is_held_by_key(spark, sf_dir, tmp_path, monkeypatch):
    """Customers and orders keep the latest valid event per key of a micro-batch and all rejects, in few partitions."""
    from tidemark.streaming import jobs

    held = []

    def split(batch, rule):
        held.append((batch.count(), batch.rdd.getNumPartitions()))
        return split_valid(batch, rule)

    monkeypatch.setattr(jobs, "split_valid", split)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        house = Lakehouse(spark, str(tmp_path), buckets=2)
        land(spark, f"{tmp_path}/landing", sf_dir, 0, BATCHES)
        run(house.start_bronze(CdcSource("files", path=f"{tmp_path}/landing"), once=True))
        run(house.start_silver(once=True))
        run(house.start_fact(once=True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for (valid, rejected), key, job, (rows_held, partitions) in zip(
        expected(spark, sf_dir), ("customer_id", "order_id"), ("customers", "fact_orders"), held, strict=True,
    ):
        assert rows_held == valid.select(key).distinct().count() + rejected.count() < BATCHES * 1000
        assert partitions < 64
        kept = spark.read.json(f"{tmp_path}/quarantine/{job}")
        assert rows(kept, "kafka_partition", "kafka_offset") == rows(rejected, "kafka_partition", "kafka_offset")
    (customers, _), (orders, _) = expected(spark, sf_dir)
    assert rows(house.silver.read()) == rows(tables.silver_state(customers))
    assert rows(house.fact.read()) == rows(tables.fact_state(orders))
    assert rows(house.fact.log.read(), "_change_type", "order_id") == rows(house.fact.read().select(F.lit("insert").alias("_change_type"), "order_id"))
