"""Tables of current rows, names in the catalog, and the end-to-end smoke flow."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators.reconcile import daily_counts, reconcile
from tidemark.schemas import AGG_ORDERS_DAILY, FACT_ORDERS, MART_DAILY_ORDERS
from tidemark.sources import files
from tidemark.sources.catalog import (
    create_empty, create_table, list_tables, load_or_fail, overwrite_partitioned, overwrite_partitions, refresh, register,
)
from tidemark.sources.state import StateTable, TableMissing
from tidemark.streaming.jobs import Lakehouse


def table(spark, path, **kw):
    return StateTable(spark, str(path), FACT_ORDERS, ("order_id",), **{"buckets": 4, "sort_by": ("event_date",), **kw})


def orders(spark, *keys, status="created", day="2025-01-01"):
    data = [(k, "c", status, 1, None) for k in keys]
    return spark.createDataFrame(data, FACT_ORDERS).withColumn("event_date", F.lit(day).cast("date"))


def bucket_files(path, buckets=4):
    return {d: sorted(f for f in os.listdir(path / f"rows_{buckets}" / d) if f.endswith(".parquet")) for d in os.listdir(path / f"rows_{buckets}") if d.startswith("bucket=")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().count() == 0 and not t.exists()
    t.write(orders(spark, *[f"o{i}" for i in range(40)]))
    assert t.exists() and t.read().schema == FACT_ORDERS
    before = bucket_files(tmp_path)
    hit = orders(spark, "o7", status="shipped")
    touched = t.touched_buckets(hit)
    assert len(touched) == 1
    t.write(t.read(touched).where("order_id <> 'o7'").unionByName(hit), touched)
    after = bucket_files(tmp_path)
    assert {d for d in before if before[d] != after[d]} == {f"bucket={touched[0]}"}
    assert rows(t.read().where("order_id = 'o7'"), "order_status") == [("shipped",)]
    assert t.read().count() == 40


def test_bucket_that_runs_empty(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.write(orders(spark, *[f"o{i}" for i in range(20)]))
    rest = t.read([1]).count()
    t.write(t.read([0]).where("false"), [0])
    assert t.read([0]).count() == 0
    assert t.read().count() == rest > 0


def test_notes_say_which_micro_batches_a_bucket_holds(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = orders(spark, *[f"o{i}" for i in range(40)])
    t.write(batch.where("order_id <> 'o7'"), None, "a", 3)
    some = t.touched_buckets(orders(spark, "o7"))
    t.write(t.read(some), some, "b", 9)
    t.write(t.read(some), some, "a", 4)
    noted = {(r["bucket"], r["_stream"]): r["_batch"] for r in t.notes(t.everything()).collect()}
    assert noted == {**{(b, "a"): 4 if b in some else 3 for b in range(4)}, (some[0], "b"): 9}
    assert t.pending(batch, "a", 3).count() == 0 and t.pending(batch, "c", 0).count() == 40
    left = t.pending(batch, "a", 4)
    assert set(t.touched_buckets(left)) == set(range(4)) - set(some)


def test_inserts_append_files(spark, tmp_path):
    t = table(spark, tmp_path)
    t.insert(orders(spark, *[f"o{i}" for i in range(40)]))
    before = bucket_files(tmp_path)
    t.insert(orders(spark, "o7"))
    after = bucket_files(tmp_path)
    assert all(set(before[d]) <= set(after[d]) for d in before) and before != after
    assert t.read().where("order_id = 'o7'").count() == 2 and t.read().count() == 41
    assert t.log.read().groupBy("_commit_version").count().orderBy("_commit_version").collect() == [(0, 40), (1, 1)]
    t.update("order_id = 'o7'", {"order_status": "'done'"})
    assert t.read().where("order_status = 'done'").count() == 2
    assert t.log.read().where("_commit_version = 2").count() == 4


def test_change_rows_of_a_replay_are_written_once(spark, tmp_path):
    t = table(spark, tmp_path)
    changed = orders(spark, "o1").withColumn("_change_type", F.lit("insert"))
    assert t.log.last_commit() == -1 and t.log.read().count() == 0
    assert t.log.append(changed, "job:x", 0) == 0 and t.log.append(changed, "job:x", 1) == 1
    assert t.log.append(changed.union(changed), "job:x", 0) == 0
    assert t.log.append(changed, "job:y", 0) == 2
    assert rows(t.log.read(), "_commit_version") == [(0,), (1,), (2,)] and t.log.last_commit() == 2


def test_half_written_change_rows_are_written_again(spark, tmp_path):
    t = table(spark, tmp_path)
    changed = orders(spark, "o1").withColumn("_change_type", F.lit("insert"))
    t.log.append(changed, "job:x", 0)
    folder = f"{t.log.path}/commit=0~x~0"
    os.remove(f"{folder}/_SUCCESS")
    assert t.log.append(changed.union(changed), "job:x", 0) == 0
    assert t.log.read().count() == 2


def test_missing_table_fails_fast(spark, tmp_path):
    with pytest.raises(TableMissing) as caught:
        load_or_fail(spark, str(tmp_path / "nowhere"))
    assert caught.value.exit_code == 2


def test_names_in_the_catalog(spark, tmp_path):
    where = str(tmp_path / "agg")
    create_empty(spark, AGG_ORDERS_DAILY, where)
    create_table(spark, "agg_named", AGG_ORDERS_DAILY, where)
    create_table(spark, "agg_named", AGG_ORDERS_DAILY, where)
    assert spark.table("agg_named").count() == 0
    assert spark.catalog.tableExists("agg_named")
    spark.sql("INSERT INTO agg_named SELECT DATE '2025-01-01', 'created', 3")
    assert spark.table("agg_named").count() == 1
    assert list_tables(spark, "agg_nam*") == ["agg_named"] and list_tables(spark, "no_such*") == []
    overwrite_partitioned(daily_counts(orders(spark, "a", "b")), str(tmp_path / "daily"), "event_date")
    register(spark, "agg_named", str(tmp_path / "daily"))
    assert rows(spark.table("agg_named"), "event_date", "order_cnt")[0][1] == 2
    daily_counts(orders(spark, "c", day="2025-02-02")).write.mode("append").partitionBy("event_date").parquet(str(tmp_path / "daily"))
    refresh(spark, "agg_named")
    assert spark.table("agg_named").count() == 2
    create_table(spark, "fact_named", FACT_ORDERS, str(tmp_path / "fact"), "event_date")
    assert spark.table("fact_named").columns[-1] == "event_date"
    for name in ("agg_named", "fact_named"):
        spark.sql(f"DROP TABLE {name}")


def test_a_refresh_replaces_dates_and_drops_those_that_are_gone(spark, tmp_path):
    where = str(tmp_path / "daily")
    days = [orders(spark, "a", "b"), orders(spark, "c", day="2025-01-02"), orders(spark, "d").withColumn("event_date", F.lit(None).cast("date"))]
    for kept in ([0, 1, 2], [1, 2], [0], [0, 2]):
        df = daily_counts(days[kept[0]])
        for k in kept[1:]:
            df = df.unionByName(daily_counts(days[k]))
        overwrite_partitions(df, where, "event_date")
        assert rows(spark.read.schema(AGG_ORDERS_DAILY).parquet(where)) == rows(df)


def test_smoke_flow(spark, tmp_path):
    """Insert, update, insert on the fact; the streamed counts follow."""
    house = Lakehouse(spark, str(tmp_path), buckets=2)

    def keep_up():
        query = house.start_agg(once=True)
        query.awaitTermination()
        assert query.exception() is None

    house.fact.insert(orders(spark, "o_demo"))
    house.fact.update("order_id = 'o_demo'", {"order_status": "'approved'"})
    keep_up()
    house.fact.insert(orders(spark, "o_demo_2", status="approved"))
    keep_up()
    assert rows(house.agg.read(), "order_status", "order_cnt") == [("approved", 2)]
    kinds = house.fact.log.read().groupBy("_change_type").count()
    assert rows(kinds, "_change_type", "count") == [
        ("insert", 2), ("update_postimage", 1), ("update_preimage", 1)]
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()


def test_counts_of_a_fact_without_change_rows(spark, tmp_path):
    """The change rows were turned on late: what is there counts, and what changes after."""
    house = Lakehouse(spark, str(tmp_path), buckets=4)
    house.fact.write(orders(spark, *[f"o{i}" for i in range(10)]))
    for _ in range(2):
        house.start_agg(once=True).awaitTermination()
    assert rows(house.agg.read(), "order_cnt") == [(10,)]
    house.fact.update("order_id = 'o3'", {"order_status": "'gone'"})
    house.start_agg(once=True).awaitTermination()
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()


def test_a_snapshot_in_the_middle_of_a_write(spark, tmp_path, monkeypatch):
    """Half of the buckets hold a write whose change rows are there in full: none counts twice, none is lost."""
    house = Lakehouse(spark, str(tmp_path), buckets=4)
    house.fact.insert(orders(spark, *[f"o{i}" for i in range(40)]))
    later = orders(spark, *[f"p{i}" for i in range(40)])
    commit = house.fact.log.append(later.withColumn("_change_type", F.lit("insert")))
    first = later.where(house.fact.bucket_of() < 2)
    house.fact.write(house.fact.read([0, 1]).unionByName(first), [0, 1], "commit", commit)
    house.start_agg(once=True).awaitTermination()
    house.fact.write(house.fact.read([2, 3]).unionByName(later.where(house.fact.bucket_of() >= 2)), [2, 3], "commit", commit)
    assert rows(house.agg.read(), "order_cnt") == [(80,)] and reconcile(house.fact.read(), house.agg.read()).isEmpty()


def test_text_files_appear_whole(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    files.write_text(spark, path, "é{}")
    assert files.read_text(spark, path) == "é{}"
    assert files.list_names(spark, f"{tmp_path}/a") and not files.exists(spark, f"{tmp_path}/zzz")
    assert files.list_names(spark, f"{tmp_path}/zzz") == []


def test_a_key_update_is_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    t.write(orders(spark, *[f"o{i}" for i in range(40)]))
    with pytest.raises(ValueError):
        t.update("order_id = 'o7'", {"order_id": "'moved'"})
    assert t.read().count() == 40 and t.log.last_commit() == -1


def test_rows_of_other_buckets_are_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    t.write(orders(spark, *[f"o{i}" for i in range(40)]))
    touched = t.touched_buckets(orders(spark, "o7"))
    with pytest.raises(Exception, match="not read"):
        t.write(t.read(), touched)
    assert t.read().count() == 40


def test_another_bucket_count_is_refused(spark, tmp_path):
    table(spark, tmp_path).write(orders(spark, "o1", "o2"))
    with pytest.raises(ValueError, match="buckets"):
        table(spark, tmp_path, buckets=3).insert(orders(spark, "o3"))


def test_a_named_mart_outlives_thirty_rebuilds(spark, tmp_path):
    """Rows come and go from build to build, dates too; the name always shows the last build."""
    house = Lakehouse(spark, str(tmp_path), buckets=2)
    house.fact.write(orders(spark, "o0"))
    house.build_mart("mart_daily_orders", register_as="lasting_mart")
    assert set(spark.table("lasting_mart").columns) == set(MART_DAILY_ORDERS.fieldNames())
    for n in range(30):
        if n % 10 == 0:
            house.fact.write(orders(spark, "o0", f"o{n}", day=f"2025-01-{n + 1:02d}").dropDuplicates(["order_id"]))
        house.build_mart("mart_daily_orders")
    want = [("2025-01-21", 2)]
    assert [(str(d), n) for d, n in rows(spark.table("lasting_mart"), "event_date", "order_count")] == want
    assert rows(house.mart("mart_daily_orders")) == rows(spark.table("lasting_mart").select(*MART_DAILY_ORDERS.fieldNames()))
    spark.sql("DROP TABLE lasting_mart")
    house.build_mart("mart_daily_orders")


def test_empty_mart_is_registered(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path), buckets=4)
    house.build_mart("mart_daily_orders", register_as="empty_mart")
    assert spark.table("empty_mart").count() == 0
    assert set(spark.table("empty_mart").columns) == {"event_date", "customer_state", "order_status", "order_count"}


def test_seed_notes_what_it_counted(spark, tmp_path):
    """A commit between seeding and the first start is counted."""
    house = Lakehouse(spark, str(tmp_path), buckets=2)
    house.fact.insert(orders(spark, "a"))
    house.seed_agg()
    house.fact.insert(orders(spark, "b", "c"))
    query = house.start_agg(once=True, start="next")
    query.awaitTermination()
    assert reconcile(house.fact.read(), house.agg.read()).isEmpty()
