"""Every registered query against its SQL in DuckDB."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# The training-data operators are tested beside them, most against brute force.
OWN = sorted(n for n in queries() if not re.match(r"op\d+_|pipeline$", n))


def test_every_query_has_sql():
    assert set(OWN) <= set(oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["event_date", "customer_state", "order_status", "order_count"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", ["dim_customers_scd2", "dim_customers_every_change", "change_feed"])
def test_sliced_histories(spark, con, sf_dir, name, monkeypatch):
    """Histories longer than a slice: the same result, cut into slices of 3."""
    from tidemark.plans import catalogue

    monkeypatch.setattr(catalogue, "SLICE", 3)
    assert compare(spark, con, name, sf_dir) == ""
