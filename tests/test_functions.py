import datetime
import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.functions.envelope import parse_envelope
from tidemark.functions.rules import customer_rule, order_rule, split_valid
from tidemark.functions.scalars import event_date, try_bigint
from tidemark.operators.changefeed import change_sign
from tidemark.schemas import BRONZE, CUSTOMERS, ORDER_ITEMS

IMAGE = {"customer_id": "c1", "customer_unique_id": "u1", "customer_city": "São Paulo", "customer_state": "SP"}


def log(spark, *values):
    return spark.createDataFrame([("t", None, v, None, 0, i) for i, v in enumerate(values)], BRONZE)


def flat(op="c", ts=5, before=None, after=None):
    return {"op": op, "ts_ms": ts, "before": before, "after": after}


@pytest.mark.parametrize("mode", ["from_json", "get_json_object"])
def test_both_envelope_shapes_and_bad_texts(spark, mode):
    good = flat(after=IMAGE)
    values = [
        json.dumps(good), json.dumps({"payload": good}),
        json.dumps(flat("d", before=IMAGE)), json.dumps({"payload": flat("d", before=IMAGE)}),
        json.dumps(flat(ts="abc", after={**IMAGE, "customer_state": None})),
        json.dumps({"payload": None, **good}),
        "{broken", '{"op":"c","after":{"customer_id":"c1"', "", "[]", "7", json.dumps(flat(after="text")), None,
    ]
    parsed = parse_envelope(log(spark, *values), CUSTOMERS, ("kafka_offset",), mode)
    got = rows(parsed, "kafka_offset", "op", "ts_ms", *CUSTOMERS.columns)
    full = ("c1", "u1", "São Paulo", "SP")
    nothing = (None,) * 6
    assert got == sorted([
        (0, "c", 5, *full), (1, "c", 5, *full),
        (2, "d", 5, "c1", None, None, None), (3, "d", 5, "c1", None, None, None),
        (4, "c", None, "c1", "u1", "São Paulo", None), (5, "c", 5, *full),
        (6, *nothing), (7, *nothing), (8, *nothing), (9, *nothing), (10, *nothing),
        (11, "c", 5, None, None, None, None), (12, *nothing),
    ], key=repr)


def test_parse_is_evaluated_once_under_a_filter(spark):
    parsed = parse_envelope(log(spark, "{}"), CUSTOMERS)
    valid, _ = split_valid(parsed, customer_rule())
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_typed_columns(spark):
    image = {"order_id": "o1", "order_item_id": 2, "product_id": "p", "price": "199.99",
             "shipping_limit_dt": 1756860199471123}
    bad = {**image, "price": "n/a", "shipping_limit_dt": "soon", "order_item_id": "x"}
    parsed = parse_envelope(log(spark, json.dumps(flat(after=image)), json.dumps(flat(after=bad))),
                            ORDER_ITEMS, ("kafka_offset",))
    assert [f.dataType.simpleString() for f in parsed.schema.fields][-5:] == [
        "string", "int", "string", "decimal(10,2)", "timestamp_ntz",
    ]
    one, two = parsed.orderBy("kafka_offset").collect()
    assert str(one.price) == "199.99"
    assert one.shipping_limit_dt == datetime.datetime(2025, 9, 3, 0, 43, 19, 471123)
    assert (two.price, two.shipping_limit_dt, two.order_item_id) == (None, None, None)


def test_try_bigint(spark):
    texts = ["12", " 12 ", "-7", "12.9", "-12.9", "12.", "abc", "", "1.75E12", "99999999999999999999", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(try_bigint(F.col("t"))).collect()]
    assert got == [12, 12, -7, 12, -12, 12, None, None, None, None, None]


@pytest.mark.parametrize("session_zone", ["UTC", "America/Bogota", "Asia/Tokyo"])
def test_event_date_zone(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame([(1756860199471,), (-500,), (-1500,), (None,)], "ms bigint")
        got = [tuple(map(str, r)) for r in df.select(
            event_date(F.col("ms")), event_date(F.col("ms"), "America/Bogota"), event_date(F.col("ms"), None),
        ).collect()]
        session = {"UTC": "2025-09-03", "America/Bogota": "2025-09-02", "Asia/Tokyo": "2025-09-03"}[session_zone]
        assert got[0] == ("2025-09-03", "2025-09-02", session)
        assert got[1][0] == "1970-01-01"  # cut toward zero
        assert got[2][0] == "1969-12-31"
        assert got[3] == ("None",) * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_customer_rule_and_bag_of_rejects(spark):
    data = [
        ("c", "a", "SP"), ("d", "a", None), ("u", "a", "XXX"), ("u", "a", "XXX"), ("r", "a", "sp"),
        ("c", "a", None), ("c", None, "SP"), ("d", None, None), ("x", "a", "SP"), (None, "a", "SP"),
    ]
    df = spark.createDataFrame(data, "op string, customer_id string, customer_state string")
    valid, rejected = split_valid(df, customer_rule())
    assert rows(valid) == sorted([("a", None, "d"), ("a", "SP", "c")], key=repr)
    assert rejected.count() == 8
    assert rows(rejected) == rows(df.exceptAll(valid))
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_order_rule(spark):
    data = [("c", "o", "c"), ("c", "o", None), ("d", "o", None), ("d", None, "c"), ("z", "o", "c")]
    df = spark.createDataFrame(data, "op string, order_id string, customer_id string")
    valid, rejected = split_valid(df, order_rule())
    assert (valid.count(), rejected.count()) == (2, 3)


def test_change_sign(spark):
    kinds = ["insert", "update_postimage", "delete", "update_preimage", "other", None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "i int, k string")
    assert [r[0] for r in df.orderBy("i").select(change_sign(F.col("k"))).collect()] == [1, 1, -1, -1, 0, 0]
