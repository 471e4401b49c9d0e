import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.functions.rules import customer_rule, split_valid
from tidemark.operators.changefeed import change_history, deltas, merge_deltas
from tidemark.operators.dedupe import delete_wins_order, latest_or_rejected, latest_per_key, stream_order
from tidemark.operators.dml import insert_rows, update_changes, update_where
from tidemark.operators.merge import Delete, Insert, MergeConflict, Update, apply_merge
from tidemark.operators.neighbours import with_neighbours
from tidemark.operators.reconcile import daily_counts, reconcile
from tidemark.operators.scd2 import (
    close_set, close_versions, compare_with_current, history_merge, open_versions, scd2_batch, scd2_history,
)
from tidemark.plans import marts, tables
from tidemark.schemas import AGG_ORDERS_DAILY, DIM_CUSTOMERS, FACT_ORDERS, HISTORY_STATE, ORDERS_ENRICHED

EVENT = """op string, ts_ms bigint, customer_id string, customer_unique_id string, customer_city string,
    customer_state string, kafka_partition int, kafka_offset bigint, batch_no bigint"""


def events(spark, *data):
    return spark.createDataFrame(list(data), EVENT)


def ev(op, ts, key, city="x", part=0, off=0, batch=0, uid="u", state="SP"):
    if op == "d":
        return (op, ts, key, None, None, None, part, off, batch)
    return (op, ts, key, uid, city, state, part, off, batch)


# --- latest per key ---------------------------------------------------------------

@pytest.mark.parametrize("method", ["max_by", "row_number"])
def test_latest_per_key_ties(spark, method):
    df = events(
        spark,
        ev("c", 5, "a", off=2), ev("u", 5, "a", city="later", off=3),
        ev("c", 5, "b", off=9), ev("d", 5, "b", off=1),
        ev("c", None, "n", off=9), ev("u", 1, "n", city="dated", off=1),
        ev("c", 5, "p", part=None, off=None), ev("u", 5, "p", city="placed", off=0),
    )
    by_stream = latest_per_key(df, ["customer_id"], stream_order(), method=method)
    assert rows(by_stream, "customer_id", "op", "customer_city") == [
        ("a", "u", "later"), ("b", "c", "x"), ("n", "u", "dated"), ("p", "u", "placed"),
    ]
    by_delete = latest_per_key(df, ["customer_id"], delete_wins_order(), method=method)
    assert rows(by_delete.where("customer_id = 'b'"), "op") == [("d",)]


def test_latest_or_rejected_loses_no_reject(spark):
    """Equal rejects, rejects of a valid key, without key, op or position: all stay, beside one valid row per key."""
    df = events(
        spark,
        ev("c", 5, "a", off=2), ev("u", 5, "a", city="later", off=3), ev("u", 9, "a", state="XXX", off=4),
        ev("d", 6, "a", off=1), ev("u", 7, None, off=5), ev("u", 7, None, off=5), ev(None, 7, "b", off=6),
        ev("u", 8, "b", state="YYY", part=None, off=None), ev("u", 8, "b", state="YYY", part=None, off=None),
        ev("c", None, "c", off=7), ev("u", None, "c", city="next", off=8),
    ).repartition(3)
    valid, rejected = split_valid(df, customer_rule())
    kept = latest_or_rejected(df, customer_rule(), ["customer_id"], stream_order())
    assert kept.columns == df.columns
    kept_valid, kept_rejected = split_valid(kept, customer_rule())
    assert rows(kept_rejected) == rows(rejected) and kept_rejected.count() == 6
    assert rows(kept_valid) == rows(latest_per_key(valid, ["customer_id"], stream_order()))
    assert rows(kept_valid, "customer_id", "op", "customer_city") == [("a", "d", None), ("c", "u", "next")]


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = events(spark, ev("c", 1, "a"))
    plan = latest_per_key(df, ["customer_id"], stream_order())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # printed top down
    plan = latest_per_key(
        df, ["customer_id"], stream_order(), method="row_number")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- neighbours ----------------------------------------------------------------------

@pytest.mark.parametrize("width", [None, 1, 3, 10, 1000])
def test_neighbours_do_not_depend_on_slices(spark, width):
    rng = random.Random(7)
    data = [("hot", i, f"v{i}") for i in range(400) if rng.random() < 0.6]
    data += [(f"k{rng.randrange(40)}", 1000 + i, f"w{i}") for i in range(200)]
    df = spark.createDataFrame(data, "k string, o bigint, v string")
    want = []
    for key in {d[0] for d in data}:
        mine = sorted(d for d in data if d[0] == key)
        for i, (k, o, v) in enumerate(mine):
            want.append((k, o, v, mine[i - 1][2] if i else None, mine[i + 1][2] if i + 1 < len(mine) else None))
    both = with_neighbours(df, ["k"], "o", {"p": "v"}, {"n": "v"}, width)
    assert rows(both, "k", "o", "v", "p", "n") == sorted(want, key=repr)
    back = with_neighbours(df, ["k"], "o", previous={"p": "v"}, slice_width=width)
    assert rows(back, "k", "o", "v", "p") == sorted((w[:4] for w in want), key=repr)
    ahead = with_neighbours(df, ["k"], "o", following={"n": "v"}, slice_width=width)
    assert rows(ahead, "k", "o", "v", "n") == sorted(((*w[:3], w[4]) for w in want), key=repr)


# --- merge ------------------------------------------------------------------------------

CLAUSES = dict(
    matched=[Delete(when="s.op = 'd'"), Update({"v": "s.v"}, when="s.op = 'u'")],
    not_matched=[Insert({"k": "s.k", "v": "s.v"}, when="s.op = 'u'")],
)


def pair(spark, target, source):
    return (spark.createDataFrame(target, "k string, v int"),
            spark.createDataFrame(source, "k string, v int, op string"))


def test_merge_rows_and_changes(spark):
    t, s = pair(spark, [("keep", 1), ("upd", 2), ("del", 3), ("odd", 4), (None, 9)],
                [("upd", 20, "u"), ("del", None, "d"), ("new", 5, "u"), ("gone", None, "d"), ("odd", 7, "?"),
                 (None, 8, "u")])
    merged = apply_merge(t, s, ["k"], **CLAUSES)
    assert rows(merged.rows(), "k", "v") == sorted(
        [("keep", 1), ("upd", 20), ("odd", 4), ("new", 5), (None, 9), (None, 8)], key=repr)
    assert rows(merged.changes(), "_change_type", "k", "v") == sorted([
        ("update_preimage", "upd", 2), ("update_postimage", "upd", 20), ("delete", "del", 3),
        ("insert", "new", 5), ("insert", None, 8)], key=repr)


def test_merge_null_safe_keys(spark):
    t, s = pair(spark, [(None, 1)], [(None, 2, "u")])
    assert rows(apply_merge(t, s, ["k"], null_safe=True, **CLAUSES).rows(), "k", "v") == [(None, 2)]


def test_merge_first_clause_wins_and_whole_rows(spark):
    t, s = pair(spark, [("a", 1)], [("a", 2, "u"), ("b", 3, "u")])
    first = apply_merge(t, s, ["k"], matched=[Update({"v": "t.v + s.v"}), Delete()])
    assert rows(first.rows(), "k", "v") == [("a", 3)]
    whole = apply_merge(t, s, ["k"], matched=[Update()], not_matched=[Insert()])
    assert rows(whole.rows(), "k", "v") == [("a", 2), ("b", 3)]


def test_merge_refuses_two_changes_of_one_row(spark):
    t, s = pair(spark, [("a", 1)], [("a", 2, "u"), ("a", 3, "u")])
    with pytest.raises(MergeConflict):
        apply_merge(t, s, ["k"], **CLAUSES)
    # Only one of the two fits a clause: fine. Repeated unmatched rows: both go in.
    t, s = pair(spark, [("a", 1)], [("a", 2, "u"), ("a", 3, "?"), ("b", 4, "u"), ("b", 5, "u")])
    assert rows(apply_merge(t, s, ["k"], **CLAUSES).rows().where("k = 'b'"), "v") == [(4,), (5,)]


def test_merge_against_a_plain_simulation(spark):
    rng = random.Random(3)
    for _ in range(3):
        target = {f"k{i}": rng.randrange(100) for i in range(60) if rng.random() < 0.7}
        source = {f"k{i}": (rng.randrange(100), rng.choice("ud?")) for i in range(90) if rng.random() < 0.5}
        want = dict(target)
        for k, (v, op) in source.items():
            if op == "u":
                want[k] = v
            elif op == "d":
                want.pop(k, None)
        t, s = pair(spark, list(target.items()), [(k, v, op) for k, (v, op) in source.items()])
        assert rows(apply_merge(t, s, ["k"], **CLAUSES).rows(), "k", "v") == sorted(want.items(), key=repr)


# --- type-2 history ------------------------------------------------------------------------

def dim_rows(df):
    return rows(df, "customer_id", "customer_city", "effective_start_ts_ms", "effective_end_ts_ms", "is_current")


def test_scd2_batch_cases(spark):
    dim = spark.createDataFrame([
        ("same", "u", "x", "SP", 1, None, True), ("new_city", "u", "x", "SP", 1, None, True),
        ("gone", "u", "x", "SP", 1, None, True), ("back", "u", "x", "SP", 1, 2, False),
        ("blank", "u", None, "SP", 1, None, True), ("idle", "u", "x", "SP", 1, None, True),
    ], DIM_CUSTOMERS)
    batch = events(
        spark, ev("u", 9, "same"), ev("u", 9, "new_city", city="y"), ev("d", 9, "gone"), ev("c", 9, "back"),
        ev("u", 9, "blank", city=""), ev("d", 9, "unknown"), ev("c", 9, "fresh"),
    )
    want = sorted([
        ("same", "x", 1, None, True), ("new_city", "x", 1, 9, False), ("new_city", "y", 9, None, True),
        ("gone", "x", 1, 9, False), ("back", "x", 1, 2, False), ("back", "x", 9, None, True),
        ("blank", None, 1, None, True), ("idle", "x", 1, None, True), ("fresh", "x", 9, None, True),
    ], key=repr)
    after = scd2_batch(dim, batch)
    assert dim_rows(after) == want
    # The same in separate steps.
    compared = compare_with_current(dim, latest_per_key(batch, ["customer_id"], delete_wins_order()))
    assert dim_rows(open_versions(close_versions(dim, close_set(compared)), compared)) == want
    # Replaying the batch adds no version (an open version starts at the event's time).
    replayed = scd2_batch(after, batch)
    assert replayed.count() == after.count()


def test_scd2_batch_without_openings(spark):
    dim = spark.createDataFrame([("a", "u", "x", "SP", 1, None, True)], DIM_CUSTOMERS)
    assert dim_rows(scd2_batch(dim, events(spark, ev("d", 5, "a")))) == [("a", "x", 1, 5, False)]
    assert dim_rows(scd2_batch(dim, events(spark, ev("u", 5, "a")))) == [("a", "x", 1, None, True)]
    empty = spark.createDataFrame([], DIM_CUSTOMERS)
    assert scd2_batch(empty, events(spark, ev("d", 5, "a"))).count() == 0


def test_scd2_late_batch_ends_before_it_starts(spark):
    dim = spark.createDataFrame([("a", "u", "x", "SP", 10, None, True)], DIM_CUSTOMERS)
    assert dim_rows(scd2_batch(dim, events(spark, ev("u", 5, "a", city="y")))) == [
        ("a", "x", 10, 5, False), ("a", "y", 5, None, True),
    ]


def random_events(n=400, keys=12, batches=8, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # A third of all events belong to one key.
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        op = rng.choice("curd")
        out.append(ev(op, i * 10, key, city=rng.choice(["x", "y", None, ""]), off=i, batch=i * batches // n))
    return out


@pytest.mark.parametrize("width", [None, 2])
def test_scd2_history_equals_the_batch_loop(spark, width):
    data = random_events()
    dim = spark.createDataFrame([], DIM_CUSTOMERS)
    for n in sorted({d[-1] for d in data}):
        dim = scd2_batch(dim, events(spark, *[d for d in data if d[-1] == n]))
        dim = spark.createDataFrame(dim.collect(), DIM_CUSTOMERS)
    assert dim_rows(scd2_history(events(spark, *data), "batch_no", slice_width=width)) == dim_rows(dim)


@pytest.mark.parametrize("width", [5, 1 << 20])
def test_scd2_every_change_equals_a_loop_over_events(spark, width):
    data = random_events(120)
    current, out = {}, []
    for op, ts, key, uid, city, state, *_ in data:
        live = current.get(key)
        attrs = (uid, city, state)
        if op == "d":
            if live:
                out.append((key, live[0][1], live[1], ts, False))
                del current[key]
        elif not live or [a or "" for a in attrs] != [a or "" for a in live[0]]:
            if live:
                out.append((key, live[0][1], live[1], ts, False))
            current[key] = (attrs, ts)
    out += [(key, attrs[1], start, None, True) for key, (attrs, start) in current.items()]
    got = scd2_history(events(spark, *data), "batch_no", collapse="none", slice_width=width)
    assert dim_rows(got) == sorted(out, key=repr)


# --- change feed and counts ---------------------------------------------------------------------

ORDER = """op string, ts_ms bigint, order_id string, customer_id string, order_status string, event_date date,
    kafka_partition int, kafka_offset bigint, batch_no bigint"""


def order(op, ts, key, status, day, batch=0, off=0, customer="c"):
    import datetime
    return (op, ts, key, customer, status, datetime.date(2025, 1, day), 0, off, batch)


def test_change_history_equals_merging_batch_by_batch(spark):
    rng = random.Random(11)
    data = [
        order(rng.choice("curd"), i, f"o{rng.randrange(9)}", rng.choice(["created", "shipped", None]),
              rng.randrange(1, 5), i // 30, i) for i in range(180)
    ]
    df = spark.createDataFrame(data, ORDER)
    fact = spark.createDataFrame([], FACT_ORDERS)
    agg = spark.createDataFrame([], AGG_ORDERS_DAILY)
    want = []
    for n in range(6):
        merged = tables.fact_merge(fact, df.where(F.col("batch_no") == n))
        changes = merged.changes()
        want += [(*r, n) for r in changes.collect()]
        agg = spark.createDataFrame(merge_deltas(agg, deltas(changes)).rows().collect(), AGG_ORDERS_DAILY)
        fact = spark.createDataFrame(merged.rows().collect(), FACT_ORDERS)
        assert reconcile(fact, agg).isEmpty()
    for width in (None, 2):
        history = tables.fact_changes(df, "batch_no", width)
        assert rows(history, *FACT_ORDERS.fieldNames(), "_change_type", "_commit_version") == sorted(want, key=repr)
    assert rows(tables.fact_state(df)) == rows(fact)
    # NULL statuses are one group each day, counted once.
    assert agg.groupBy("event_date", "order_status").count().where("count > 1").isEmpty()


def test_moving_an_order_to_another_day(spark):
    fact = spark.createDataFrame([("o", "c", "created", 1, None)], FACT_ORDERS).withColumn(
        "event_date", F.lit("2025-01-01").cast("date"))
    merged = tables.fact_merge(fact, spark.createDataFrame([order("u", 2, "o", "created", 2)], ORDER))
    assert [(str(r[0]), r[2]) for r in deltas(merged.changes()).orderBy("event_date").collect()] == [
        ("2025-01-01", -1), ("2025-01-02", 1)]
    after = merge_deltas(daily_counts(fact), deltas(merged.changes())).rows()
    assert [r[0] for r in after.orderBy("event_date").select("order_cnt").collect()] == [0, 1]
    assert reconcile(merged.rows(), after).isEmpty()


def test_zero_deltas(spark):
    data = [("2025-01-01", "a", "insert"), ("2025-01-01", "a", "delete"), ("2025-01-01", "b", "insert"),
            ("2025-01-01", "z", "unknown")]
    df = spark.createDataFrame(data, "event_date string, order_status string, _change_type string")
    assert rows(deltas(df), "order_status", "delta_cnt") == [("b", 1)]
    assert rows(deltas(df, drop_zero="before"), "order_status", "delta_cnt") == [("a", 0), ("b", 1)]


def test_reconcile_finds_differences(spark):
    fact = spark.createDataFrame([("o1", "c", None, 1, None), ("o2", "c", "a", 1, None)], FACT_ORDERS)
    good = daily_counts(fact)
    assert reconcile(fact, good).isEmpty()
    bad = good.withColumn("order_cnt", F.when(F.col("order_status").isNull(), 5).otherwise(F.col("order_cnt")))
    assert rows(reconcile(fact, bad), "order_status", "cnt_fact", "cnt_agg") == [(None, 1, 5)]
    ghost = good.where("false")
    assert reconcile(fact, ghost).count() == 2


# --- guard, marts, row changes -------------------------------------------------------------------

def test_guard_keeps_newer_rows(spark):
    target = tables.silver_state(events(spark, ev("c", 100, "a", city="new")))
    late = events(spark, ev("u", 50, "a", city="old"))
    assert rows(tables.silver_merge(target, late).rows(), "customer_city", "_last_ts_ms") == [("old", 50)]
    assert rows(tables.silver_merge(target, late, "event_time").rows(), "customer_city", "_last_ts_ms") == [
        ("new", 100)]
    gone = events(spark, ev("d", 50, "a"))
    assert tables.silver_merge(target, gone).rows().count() == 0
    assert tables.silver_merge(target, gone, "event_time").rows().count() == 1


def test_marts_with_a_hot_and_a_missing_customer(spark):
    data = [(f"o{i}", "hot" if i % 3 else "nobody", "created", 1, None) for i in range(90)]
    fact = spark.createDataFrame(data, FACT_ORDERS)
    dim = spark.createDataFrame([("hot", "u", "x", "SP", 1, None, True), ("hot", "u", "y", "RJ", 0, 1, False)],
                                DIM_CUSTOMERS)
    assert rows(marts.mart_daily_orders(fact, dim), "customer_state", "order_count") == sorted(
        [("SP", 60), (None, 30)], key=repr)
    assert rows(marts.mart_orders_by_state(fact, dim), "customer_state", "orders_cnt") == sorted(
        [("SP", 60), (None, 30)], key=repr)


def test_enriched_upsert_and_clash(spark):
    fact = spark.createDataFrame([("o1", "c", "created", 1, None), ("o2", "n", "created", 1, None)], FACT_ORDERS)
    one = ("c", "u", "x", "SP", 1, None, True)
    dim = spark.createDataFrame([one], DIM_CUSTOMERS)
    start = spark.createDataFrame([("o0", "c", "created", 1, None, "x", "SP")], ORDERS_ENRICHED)
    merged = marts.orders_enriched_merge(start, marts.enrich_orders(fact, dim)).rows()
    assert rows(merged, "order_id", "customer_city") == [("o0", "x"), ("o1", "x"), ("o2", None)]
    twice = spark.createDataFrame([one, ("c", "u", "y", "SP", 2, None, True)], DIM_CUSTOMERS)
    with pytest.raises(MergeConflict):
        marts.orders_enriched_merge(merged, marts.enrich_orders(fact, twice))


def test_dml(spark):
    fact = spark.createDataFrame([("o", "c", "created", 1, None), ("o", "c", "created", 2, None)], FACT_ORDERS)
    more = insert_rows(fact, spark.createDataFrame([("created", "o", "c", 3)],
                       "order_status string, order_id string, customer_id string, event_ts_ms int")
                       .withColumn("event_date", F.lit(None).cast("date")))
    assert more.count() == 3 and more.schema == FACT_ORDERS
    cond, new = "event_ts_ms > 1", {"order_status": "'approved'"}
    assert rows(update_where(more, cond, new), "event_ts_ms", "order_status") == [
        (1, "created"), (2, "approved"), (3, "approved")]
    assert update_changes(more, cond, new).groupBy("_change_type").count().orderBy("_change_type").collect() == [
        ("update_postimage", 2), ("update_preimage", 2)]
    assert update_where(more, "customer_id = NULL", new).where("order_status = 'approved'").count() == 0


def test_change_history_of_unknown_deletes_is_empty(spark):
    df = spark.createDataFrame([order("d", 1, "o", None, 1)], ORDER).withColumn("event_ts_ms", F.col("ts_ms"))
    assert change_history(df, ["order_id"], FACT_ORDERS.fieldNames(), "batch_no").count() == 0


def test_history_slices_spread_a_hot_key(spark):
    """The first window of a sliced history is partitioned by key and slice."""
    df = events(spark, *random_events(60))
    plan = scd2_history(df, "batch_no", collapse="none")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in plan and "_slice" in plan
    plain = scd2_history(df, "batch_no", slice_width=None)._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Exchange hashpartitioning") == 2


def test_two_current_versions_of_a_key_raise(spark):
    schema = "customer_id string, customer_unique_id string, customer_city string, customer_state string, effective_start_ts_ms long, effective_end_ts_ms long, is_current boolean"
    dim = spark.createDataFrame([("a", "u", "x", "SP", 1, None, True), ("a", "u", "y", "SP", 2, None, True)], schema)
    batch = spark.createDataFrame(
        [("u", 5, "a", "u", "z", "SP", 0, 1)],
        "op string, ts_ms long, customer_id string, customer_unique_id string, customer_city string, customer_state string, kafka_partition int, kafka_offset long",
    )
    with pytest.raises(Exception, match="several current versions"):
        scd2_batch(dim, batch).collect()


# --- history that takes late events ------------------------------------------------------

def mixed_events(seed, keys, many):
    rng = random.Random(seed)
    rows_ = []
    for offset in range(many):
        kind = rng.choice("cuuud")
        city = None if kind == "d" else rng.choice(("x", "y", None, ""))
        ts = None if rng.random() < 0.02 else rng.randrange(30) << 30
        rows_.append((kind, ts, f"k{rng.randrange(keys)}", None if kind == "d" else "u", city, None if kind == "d" else "SP", rng.choice((0, 1, None)), offset))
    return rows_


EVENTS = "op string, ts_ms bigint, customer_id string, customer_unique_id string, customer_city string, customer_state string, kafka_partition int, kafka_offset bigint"


def plain_history(events):
    """Versions per key over the events in order, one after another."""
    out = []
    for key in {e[2] for e in events}:
        mine = sorted((e for e in events if e[2] == key), key=lambda e: (e[1] is not None, e[1] or 0, e[0] == "d", -1 if e[6] is None else e[6], e[7]))
        live, started = None, None
        for e in mine:
            attrs = tuple(a or "" for a in e[3:6])
            if e[0] == "d" and live is not None:
                out.append((key, *live[1], started, e[1], False))
                live = None
            elif e[0] != "d" and (live is None or live[0] != attrs):
                if live is not None:
                    out.append((key, *live[1], started, e[1], False))
                live, started = (attrs, e[3:6]), e[1]
        if live is not None:
            out.append((key, *live[1], started, None, True))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_history_does_not_depend_on_how_events_come(spark, seed):
    """Batches in any order, some events twice: the versions of all events in event order."""
    events = mixed_events(seed, 6, 150)
    rng = random.Random(seed + 100)
    mixed = events if seed == 0 else rng.sample(events, len(events))
    cuts = [mixed[:70], mixed[70:80], mixed[60:75], mixed[80:]]
    state = spark.createDataFrame([], HISTORY_STATE)
    for cut in cuts:
        state = history_merge(state, spark.createDataFrame(cut, EVENTS), slice_ms=rng.choice((1 << 30, 1 << 32, None)))
        state = spark.createDataFrame(state.collect(), HISTORY_STATE)
    assert state.count() == len(events)
    assert rows(state.where("_opens"), *DIM_CUSTOMERS.fieldNames()) == plain_history(events)


def test_a_late_event_cuts_a_version_and_drops_a_boundary(spark):
    def step(state, *events):
        batch = spark.createDataFrame([(op, ts, "a", "u", city, "SP", 0, n) for n, (op, ts, city) in enumerate(events)], EVENTS)
        return history_merge(state, batch)

    def seen(state):
        return rows(state.where("_opens"), "customer_city", "effective_start_ts_ms", "effective_end_ts_ms")

    state = step(spark.createDataFrame([], HISTORY_STATE), ("c", 10, "x"), ("u", 30, "y"))
    assert seen(state) == [("x", 10, 30), ("y", 30, None)]
    state = step(state, ("u", 20, "y"))
    assert seen(state) == [("x", 10, 20), ("y", 20, None)]
    state = step(state, ("d", 25, None))  # the boundary at 30 comes back
    assert seen(state) == [("x", 10, 20), ("y", 20, 25), ("y", 30, None)]


def test_events_in_order_leave_closed_versions_alone(spark):
    """A long history is not sorted again: only the current version meets the batch."""
    old = [("u", t, "a", "u", f"c{t}", "SP", 0, t) for t in range(200)]
    state = history_merge(spark.createDataFrame([], HISTORY_STATE), spark.createDataFrame(old, EVENTS))
    state = spark.createDataFrame(state.collect(), HISTORY_STATE)
    plan = history_merge(state, spark.createDataFrame([("u", 500, "a", "u", "new", "SP", 0, 500)], EVENTS))
    assert plan.where("_opens").count() == 201
    kept = state.where("NOT is_current").drop("_partition", "_offset").exceptAll(plan.drop("_partition", "_offset"))
    assert kept.isEmpty()


@pytest.mark.parametrize("slice_ms", [1 << 3, None])
def test_a_history_is_shuffled_once_whatever_comes_twice(spark, slice_ms):
    """Repeated events count once in the sort of the history itself, without an aggregate of their own before it."""
    from tidemark.operators.scd2 import history_state

    data = [("c", 10, "a", "u", "x", "SP", 0, 1), ("u", 30, "a", "u", "y", "SP", 0, 2), ("u", 30, "a", "u", "y", "SP", 1, 2), ("d", 40, "a", None, None, None, 0, 3)]
    twice = spark.createDataFrame([*data, *data, ("u", 30, "a", "u", "w", "SP", 0, 2), ("u", None, "b", "u", "n", "SP", None, None)], EVENTS)
    events_ = twice.withColumnsRenamed({"kafka_partition": "_partition", "kafka_offset": "_offset"})
    state = history_state(events_, slice_ms=slice_ms)
    assert rows(state, "customer_id", "_partition", "_offset", "customer_city", "effective_end_ts_ms", "_opens") == sorted([
        ("a", 0, 1, "x", 30, True), ("a", 0, 2, "y", 40, True), ("a", 1, 2, "y", None, False), ("a", 0, 3, None, None, False),
        ("b", None, None, "n", None, True),
    ], key=repr)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert "max(struct" not in plan


def test_keys_are_cut_only_where_one_has_many_rows(spark):
    from tidemark.operators.scd2 import TIME_SLICE, slice_for

    batch = spark.createDataFrame([("u", t, k, "u", "x", "SP", 0, t) for t in range(6) for k in "ab"], EVENTS)
    empty = spark.createDataFrame([], HISTORY_STATE)
    state = spark.createDataFrame(history_merge(empty, batch).collect(), HISTORY_STATE)
    assert slice_for(empty, batch, few=5) == TIME_SLICE and slice_for(empty, batch, few=6) is None
    assert slice_for(state, batch, few=11) == TIME_SLICE and slice_for(state, batch, few=12) is None
