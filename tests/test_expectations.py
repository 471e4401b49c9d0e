import json

from helpers import rows
from tidemark.operators import expectations as E
from tidemark.schemas import AGG_ORDERS_DAILY, FACT_ORDERS, SILVER_CUSTOMERS
from tidemark.sources.reports import exit_code, quarantine, write_report

COUNTS = ("position", "observed_value", "element_count", "missing_count", "unexpected_count", "success")


def silver(spark, *states):
    data = [(f"c{i}", "u", "x", s, 1) for i, s in enumerate(states)]
    return spark.createDataFrame(data, SILVER_CUSTOMERS)


def test_failing_customer_suite(spark):
    df = silver(spark, *(["SP"] * 5 + ["XXX"] * 6))
    suite = E.silver_customers_suite()
    assert rows(suite.validate(df), *COUNTS) == [
        (1, None, 11, 0, 0, True), (2, None, 11, 0, 0, True), (3, None, 11, 0, 6, False),
        (4, 11, None, None, None, True),
    ]
    bad = E.with_percents(suite.validate(df)).where("position = 3").first()
    assert (bad.missing_percent, round(bad.unexpected_percent, 4)) == (0.0, 54.5455)
    assert rows(suite.unexpected_values(df), "column", "value", "count") == [("customer_state", "XXX", 6)]
    stats = E.statistics(suite.validate(df)).first()
    assert (stats.evaluated_expectations, stats.successful_expectations, stats.success_percent) == (4, 3, 75.0)
    assert not stats.success


def test_empty_table(spark):
    result = E.silver_customers_suite().validate(silver(spark))
    assert rows(result, "position", "success") == [(1, True), (2, True), (3, True), (4, False)]
    assert rows(E.with_percents(result), "unexpected_percent") == [(None,)] * 4
    agg = spark.createDataFrame([], AGG_ORDERS_DAILY)
    assert E.agg_orders_daily_suite().validate(agg).where("NOT success").isEmpty()


def test_nulls_are_missing_not_unexpected(spark):
    result = E.silver_customers_suite().validate(silver(spark, "SP", None, "sp"))
    assert rows(result.where("position = 3"), *COUNTS) == [(3, None, 3, 1, 1, False)]


def test_fact_suite(spark):
    data = [("o1", "c", "returned", 1, None), ("o1", None, "created", -5, None), (None, "c", "lost", 1, None),
            (None, "c", None, None, None)]
    result = E.fact_orders_suite().validate(spark.createDataFrame(data, FACT_ORDERS))
    assert sorted(rows(result, "position", "missing_count", "unexpected_count", "success")) == [
        (1, None, None, True), (2, 2, 2, False), (3, 1, 1, False), (4, 2, 2, False), (5, 1, 1, False),
        (6, 1, 1, False), (7, 4, 4, False), (8, None, None, False), (9, 1, 1, False), (10, 1, 1, False),
    ]


def test_aggregate_suite_and_missing_column(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (None, None, 1), (None, "returned", 2), (None, "created", -1)], AGG_ORDERS_DAILY)
    result = E.agg_orders_daily_suite().validate(df)
    assert rows(result, "position", "missing_count", "unexpected_count", "success") == [
        (1, None, None, True), (2, None, None, True), (3, None, None, True), (4, None, None, True),
        (5, 4, 4, False), (6, 2, 2, False), (7, 0, 1, False), (8, 2, 1, False), (9, 2, 0, True),
    ]
    dropped = E.agg_orders_daily_suite().validate(df.drop("order_cnt"))
    assert rows(dropped.where("NOT success"), "position") == [(4,), (5,), (6,), (7,), (8,)]
    again = df.unionByName(df.where("order_status = 'created'"))
    assert rows(E.agg_orders_daily_suite().validate(again).where("position = 9"), "unexpected_count") == [(2,)]


def test_suite_is_one_scan(spark, sf_dir):
    """One pass for all checks, uniqueness included."""
    from tidemark.sources.replay import bulk_fact

    plan = E.fact_orders_suite().validate(bulk_fact(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_report_file(spark, tmp_path):
    df = silver(spark, "SP", "XXX", "XXX", "YYYY")
    success, folder = write_report(E.silver_customers_suite(), df, str(tmp_path), now=1700000000)
    assert folder.endswith("silver_customers/1700000000") and exit_code(success) == 1
    import glob
    (part,) = glob.glob(f"{folder}/result.json/part-*.json")
    report = json.load(open(part))
    assert report["success"] is False
    assert report["statistics"] == {"evaluated_expectations": 4, "successful_expectations": 3,
                                    "unsuccessful_expectations": 1, "success_percent": 75.0}
    kinds = [r["expectation"] for r in report["results"]]
    assert kinds == [c.kind for c in E.silver_customers_suite().checks]
    assert report["results"][2]["partial_unexpected_counts"] == [
        {"value": "XXX", "count": 2}, {"value": "YYYY", "count": 1}]
    assert report["results"][2]["unexpected_percent"] == 75.0


def test_sample_is_cut_but_values_are_whole(spark):
    df = silver(spark, *[f"bad{i:03d}" for i in range(50)])
    values = E.silver_customers_suite().unexpected_values(df)
    assert values.count() == 50
    assert len(E.sample_of(values).first().partial_unexpected_counts) == E.SAMPLE_SIZE


def test_quarantine_replay_keeps_rows_once(spark, tmp_path):
    bad = spark.createDataFrame([("c", "x"), ("c", "x")], "op string, customer_id string")
    assert not quarantine(bad.where("false"), str(tmp_path / "none"), "job:a", 0)
    assert not (tmp_path / "none").exists()
    for _ in range(2):
        assert quarantine(bad, str(tmp_path / "q"), "job:a", 4)
    assert spark.read.json(str(tmp_path / "q")).count() == 2
    # A new checkpoint counts from 0 again: its batches are other batches.
    assert quarantine(bad, str(tmp_path / "q"), "job:b", 4)
    assert spark.read.json(str(tmp_path / "q")).count() == 4
    assert not quarantine(bad.where("false"), str(tmp_path / "q"), "job:b", 4)
    assert spark.read.json(str(tmp_path / "q")).count() == 2
