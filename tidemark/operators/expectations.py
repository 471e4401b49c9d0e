"""Data-quality suites, compiled to aggregates.

All checks of a suite come out of one pass: counts of rows, nulls and breaches are
summed along with the groups that uniqueness and distinct counts need. The result is a
small DataFrame, one row per check; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.rules import STATE_PATTERN

SAMPLE_SIZE = 20  # fixed value: most unexpected values a report lists per check


@dataclass(frozen=True)
class Expectation:
    """One check. ``kind`` is one of the constructors below."""

    kind: str
    columns: tuple[str, ...] = ()
    low: float | int | None = None
    high: float | int | None = None
    pattern: str | None = None
    allowed: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def row_count_between(low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("expect_table_row_count_to_be_between", low=low, high=high)


def column_exists(column: str) -> Expectation:
    return Expectation("expect_column_to_exist", (column,))


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", (column,))


def unique(column: str) -> Expectation:
    return Expectation("expect_column_values_to_be_unique", (column,))


def compound_unique(*columns: str) -> Expectation:
    return Expectation("expect_compound_columns_to_be_unique", columns)


def matches_regex(column: str, pattern: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", (column,), pattern=pattern)


def in_set(column: str, allowed: Sequence[str]) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", (column,), allowed=tuple(allowed))


def between(column: str, low: float | int | None = None, high: float | int | None = None) -> Expectation:
    return Expectation("expect_column_values_to_be_between", (column,), low=low, high=high)


def unique_count_between(column: str, low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("expect_column_unique_value_count_to_be_between", (column,), low=low, high=high)


_DISTINCT = "expect_column_unique_value_count_to_be_between"
_UNIQUE = ("expect_column_values_to_be_unique", "expect_compound_columns_to_be_unique")
_TABLE = ("expect_table_row_count_to_be_between", "expect_column_to_exist")


def _within(value: Column, check: Expectation) -> Column:
    ok = F.lit(True)
    if check.low is not None:
        ok = ok & (value >= F.lit(check.low))
    if check.high is not None:
        ok = ok & (value <= F.lit(check.high))
    return ok


def _unexpected(check: Expectation) -> Column:
    """True on the rows that break a column-value check; NULL values never do,
    except under the null check itself."""
    value = F.col(check.columns[0])
    if check.kind == "expect_column_values_to_not_be_null":
        return value.isNull()
    if check.kind == "expect_column_values_to_match_regex":
        ok = value.rlike(check.pattern)
    elif check.kind == "expect_column_values_to_be_in_set":
        ok = value.isin(*check.allowed)
    else:
        ok = _within(value, check)
    return value.isNotNull() & ~ok


@dataclass(frozen=True)
class Suite:
    name: str
    checks: tuple[Expectation, ...]

    def validate(self, df: DataFrame) -> DataFrame:
        """One row per check; ``position`` is its place in the suite.

        One scan and one shuffle: the key columns of the uniqueness and distinct-count checks
        are grouping sets of one aggregate, and all other checks are counted along with the first.
        """
        numbered = list(enumerate(self.checks, start=1))
        absent = {n for n, c in numbered if any(col not in df.columns for col in c.columns)}
        measures, sets = {}, {}
        for n, check in numbered:
            if n in absent or check.kind in _TABLE:
                continue
            if check.kind in (*_UNIQUE, _DISTINCT):
                sets.setdefault(tuple(dict.fromkeys(check.columns)), []).append((n, check))
                continue
            measures[f"_u{n}"] = F.count_if(_unexpected(check))
            measures[f"_m{n}"] = F.count_if(F.col(check.columns[0]).isNull())
        counted = [F.count(F.lit(1)).alias("_n"), *[m.alias(name) for name, m in measures.items()]]
        totals = self._by_sets(df, sets, counted, list(measures)) if sets else df.agg(*counted)
        return totals.select(F.inline(F.array(*[self._outcome(n, c, n in absent) for n, c in numbered])))

    def _by_sets(self, df: DataFrame, sets: dict, counted: list[Column], measures: list[str]) -> DataFrame:
        columns = list(dict.fromkeys(c for key in sets for c in key))
        grouped = df.groupingSets([[F.col(c) for c in key] for key in sets], *columns).agg(*counted, F.grouping_id().alias("_set"))
        # The bit of a column is set where the grouping set lacks it, the last column's being the lowest.
        ids = {key: sum(1 << (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in key) for key in sets}
        total = lambda met, value: F.coalesce(F.sum(F.when(met, value)), F.lit(0).cast("bigint"))
        first = F.col("_set") == ids[next(iter(sets))]
        out = [total(first, F.col(name)).alias(name) for name in ("_n", *measures)]
        for key, checks in sets.items():
            mine = F.col("_set") == ids[key]
            # A row is left out only when all of its key columns are NULL.
            missing = reduce(Column.__and__, [F.col(c).isNull() for c in key])
            for n, check in checks:
                if check.kind == _DISTINCT:
                    out.append(F.count_if(mine & ~missing).alias(f"_d{n}"))
                else:
                    out.append(total(mine & missing, F.col("_n")).alias(f"_m{n}"))
                    out.append(total(mine & ~missing & (F.col("_n") > 1), F.col("_n")).alias(f"_u{n}"))
        return grouped.agg(*out)

    def _outcome(self, n: int, check: Expectation, absent: bool) -> Column:
        if check.kind == "expect_column_to_exist" or absent:
            return self._row(n, check, F.lit(not absent))
        if check.kind == "expect_table_row_count_to_be_between":
            return self._row(n, check, _within(F.col("_n"), check), observed_value=F.col("_n"))
        if check.kind == _DISTINCT:
            seen = F.col(f"_d{n}")
            return self._row(n, check, _within(seen, check), observed_value=seen, element_count=F.col("_n"))
        bad = F.col(f"_u{n}")
        return self._row(n, check, bad == 0, element_count=F.col("_n"), missing_count=F.col(f"_m{n}"), unexpected_count=bad)

    def _row(self, position: int, check: Expectation, success: Column, **counts: Column) -> Column:
        def count(name: str) -> Column:
            return counts.get(name, F.lit(None)).cast("bigint").alias(name)

        return F.struct(
            F.lit(self.name).alias("suite"), F.lit(position).alias("position"),
            F.lit(check.kind).alias("expectation"), F.lit(check.label).alias("column"),
            count("observed_value"), count("element_count"), count("missing_count"),
            count("unexpected_count"), success.alias("success"),
        )

    def unexpected_values(self, df: DataFrame) -> DataFrame:
        """Every unexpected value with its count, for the checks on single values.

        All checks share one scan and one grouped count: each row emits a
        (check, value) pair per check it breaks.
        """
        kinds = (
            "expect_column_values_to_match_regex", "expect_column_values_to_be_in_set",
            "expect_column_values_to_be_between",
        )
        broken = [
            F.when(_unexpected(c), F.struct(
                F.lit(n).alias("position"), F.lit(c.kind).alias("expectation"),
                F.lit(c.label).alias("column"), F.col(c.columns[0]).cast("string").alias("value"),
            ))
            for n, c in enumerate(self.checks, start=1) if c.kind in kinds and c.columns[0] in df.columns
        ]
        parts = []
        group = ["position", "expectation", "column", "value"]
        if broken:
            pairs = df.select(F.inline(F.filter(F.array(*broken), lambda pair: pair.isNotNull())))
            parts.append(pairs.groupBy(*group).agg(F.count(F.lit(1)).alias("count")))
        for n, c in enumerate(self.checks, start=1):
            if c.kind == "expect_column_values_to_be_unique" and c.columns[0] in df.columns:
                value = F.col(c.columns[0])
                parts.append(
                    df.where(value.isNotNull()).groupBy(value.cast("string").alias("value"))
                    .agg(F.count(F.lit(1)).alias("count")).where("count > 1")
                    .select(F.lit(n).alias("position"), F.lit(c.kind).alias("expectation"),
                            F.lit(c.label).alias("column"), "value", "count")
                )
        return reduce(DataFrame.unionByName, parts).withColumn("suite", F.lit(self.name))


def with_percents(results: DataFrame) -> DataFrame:
    """Add missing and unexpected percents; an empty table has none."""
    return results.withColumn(
        "missing_percent", F.expr("100 * missing_count / nullif(element_count, 0)"),
    ).withColumn(
        "unexpected_percent", F.expr("100 * unexpected_count / nullif(element_count, 0)"),
    ).withColumn(
        "unexpected_percent_nonmissing",
        F.expr("100 * unexpected_count / nullif(element_count - missing_count, 0)"),
    )


def statistics(results: DataFrame) -> DataFrame:
    """Per suite: checks evaluated, passed, failed, percent passed and the outcome."""
    passed = F.count_if("success")
    evaluated = F.count(F.lit(1))
    return results.groupBy("suite").agg(
        evaluated.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (evaluated - passed).alias("unsuccessful_expectations"),
        (F.lit(100.0) * passed / evaluated).alias("success_percent"),
        (passed == evaluated).alias("success"),
    )


def sample_of(values: DataFrame) -> DataFrame:
    """The most frequent unexpected values of each check, at most ``SAMPLE_SIZE``:
    what a report lists. ``unexpected_values`` itself is complete."""
    rank = Window.partitionBy("suite", "position").orderBy(F.desc("count"), "value")
    top = values.withColumn("_rn", F.row_number().over(rank)).where(F.col("_rn") <= SAMPLE_SIZE)
    return top.groupBy("suite", "position").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("_o"), "value", "count"))).alias("_v"),
    ).select(
        "suite", "position",
        F.transform("_v", lambda v: F.struct(v["value"].alias("value"), v["count"].alias("count")))
        .alias("partial_unexpected_counts"),
    )


def report(suite: Suite, df: DataFrame) -> DataFrame:
    """The whole outcome of a suite as one nested row, ready to be written as JSON."""
    results = with_percents(suite.validate(df)).join(
        sample_of(suite.unexpected_values(df)).drop("suite"), "position", "left",
    )
    columns = [c for c in results.columns if c not in ("suite", "position")]
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("position", *columns))),
        lambda r: F.struct(*[r[c].alias(c) for c in columns]),
    )
    passed, evaluated = F.count_if("success"), F.count(F.lit(1))
    return results.groupBy("suite").agg(
        (passed == evaluated).alias("success"),
        F.struct(
            evaluated.alias("evaluated_expectations"), passed.alias("successful_expectations"),
            (evaluated - passed).alias("unsuccessful_expectations"),
            (F.lit(100.0) * passed / evaluated).alias("success_percent"),
        ).alias("statistics"),
        ordered.alias("results"),
    )


# Order statuses the two tables may hold.
FACT_STATUSES = (
    "created", "approved", "invoiced", "shipped", "delivered",
    "canceled", "processing", "unavailable", "in_review", "returned",
)
AGG_STATUSES = (
    "created", "approved", "delivered", "canceled", "invoiced", "shipped", "processing",
)


def silver_customers_suite() -> Suite:
    return Suite("silver_customers", (
        not_null("customer_id"),
        unique("customer_id"),
        matches_regex("customer_state", STATE_PATTERN),
        row_count_between(low=1),
    ))


def fact_orders_suite(statuses: Sequence[str] = FACT_STATUSES) -> Suite:
    return Suite("fact_orders", (
        row_count_between(low=1),
        not_null("order_id"),
        not_null("customer_id"),
        unique("order_id"),
        not_null("order_status"),
        in_set("order_status", statuses),
        not_null("event_date"),
        unique_count_between("event_date", low=1),
        not_null("event_ts_ms"),
        between("event_ts_ms", low=0),
    ))


def agg_orders_daily_suite(statuses: Sequence[str] = AGG_STATUSES) -> Suite:
    return Suite("agg_orders_daily", (
        row_count_between(low=0),
        column_exists("event_date"),
        column_exists("order_status"),
        column_exists("order_cnt"),
        not_null("event_date"),
        not_null("order_status"),
        between("order_cnt", low=0),
        in_set("order_status", statuses),
        compound_unique("event_date", "order_status"),
    ))
