import pytest

from helpers import rows
from test_streaming import event, put
from tidemark import __main__ as cli
from tidemark.sources.bronze import CdcSource, read_cdc_stream
from tidemark.streaming.jobs import Lakehouse


def test_command_line(spark, tmp_path, capsys):
    root = str(tmp_path)
    put(spark, f"{root}/landing", 0, event("c", 10, "a"), event("c", 10, "b"), event("c", 11, "x", state="XXX"))

    def run(*argv):
        return cli.main([*argv, "--root", root, "--buckets", "2"])

    assert run("validate", "--name", "silver_customers") == 2
    assert run("bronze", "--landing", f"{root}/landing", "--once") == 0
    assert run("silver", "--once") == 0 and run("dim", "--once") == 0 and run("history", "--once") == 0 and run("fact", "--once") == 0
    assert run("validate", "--name", "silver_customers") == 0
    house = Lakehouse(spark, root, buckets=2)
    assert rows(house.silver.read(), "customer_id") == [("a",), ("b",)]
    house.silver.insert(house.silver.read())
    assert run("validate", "--name", "silver_customers") == 1
    assert run("seed") == 0 and run("agg", "--once", "--start", "next") == 0
    assert run("mart") == 0 and run("enriched") == 0 and run("reconcile") == 0
    assert "differences" in capsys.readouterr().out


def test_topics_by_name_and_by_prefix(spark, tmp_path):
    assert CdcSource.captured_topics("p") == (
        "p.public.customers", "p.public.products", "p.public.orders", "p.public.order_items")
    put(spark, str(tmp_path), 0, event("c", 1, "a"))
    for source, expected in (
        (CdcSource("files", path=str(tmp_path)), 1),
        (CdcSource("files", prefix="other", path=str(tmp_path)), 0),
        (CdcSource("files", path=str(tmp_path), topics=("shop.public.orders",)), 0),
        (CdcSource("files", path=str(tmp_path), topics=("shop.public.customers",)), 1),
    ):
        seen = []
        query = read_cdc_stream(spark, source).writeStream.trigger(availableNow=True).foreachBatch(
            lambda df, _, seen=seen: seen.append(df.count())).start()
        query.awaitTermination()
        assert sum(seen) == expected
    with pytest.raises(ValueError):
        read_cdc_stream(spark, CdcSource("socket"))
