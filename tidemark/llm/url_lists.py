"""URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (a pattern is added to, or removed from, a list on a date) become
validity intervals. A pattern is a host or a parent domain and holds for every host below
it. Per host, the intervals of all its patterns fold into a time line of disjoint
segments with the number of entries in force, and every capture is matched as of its
fetch time with the one segment that holds then.

Hosts are collapsed before patterns meet them, so a host with a third of all captures
counts once there. The last join adds the month to its key: a busy host is spread over
months, and what is left of its skew Spark splits (a plain equi-join on both sides).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import set_aside

#: Seconds of a period of the join key.
PERIOD = 30 * 86_400


def url_host(url: Column) -> Column:
    """The host in lower case, without user and port; null if the address has none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.when(found != "", found)


def parent_domains(host: Column) -> Column:
    """The host and all domains above it, the longest first."""
    labels = F.split(host, "[.]")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_to) of dated entries (list_name, pattern, dated_at, action).

    ``action`` is add or remove. An interval runs from an add to the pattern's next entry in
    that list, the end not included, and is open (null) without one. Of entries of the same
    instant a removal wins. Entries without list, pattern or date, and other actions, say nothing.
    """
    known = entries.where(
        F.col("list_name").isNotNull() & F.col("pattern").isNotNull() & F.col("dated_at").isNotNull() & F.col("action").isin("add", "remove")
    ).select("list_name", F.lower("pattern").alias("pattern"), "dated_at", "action")
    states = known.groupBy("list_name", "pattern", "dated_at").agg(F.min(F.col("action") == "add").alias("on"))
    following = F.lead("dated_at").over(Window.partitionBy("list_name", "pattern").orderBy("dated_at"))
    return states.withColumn("valid_to", following).where("on").select("list_name", "pattern", F.col("dated_at").alias("valid_from"), "valid_to")


def host_segments(hosts: DataFrame, intervals: DataFrame) -> DataFrame:
    """(host, seg_from, seg_to, active_entries): disjoint segments, those with entries in force only."""
    matched = hosts.select("host", F.explode(parent_domains(F.col("host"))).alias("pattern")).join(intervals, "pattern")
    steps = matched.select("host", F.col("valid_from").alias("at"), F.lit(1).alias("step")).union(
        matched.where("valid_to is not null").select("host", "valid_to", F.lit(-1))
    )
    steps = steps.groupBy("host", "at").agg(F.sum("step").alias("step"))
    line = Window.partitionBy("host").orderBy("at")
    return steps.select(
        "host", F.col("at").alias("seg_from"), F.lead("at").over(line).alias("seg_to"), F.sum("step").over(line).alias("active_entries")
    ).where("active_entries > 0")


def listed_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (url, fetched_at, and other columns) with host, active_entries and blocked.

    A capture without host or fetch time meets no entry. Captures that repeat stay as often
    as they are. Columns named host, active_entries or blocked are replaced.
    """
    clash = [c for c in ("host", "active_entries", "blocked") if c in captures.columns]
    captures = captures.drop(*clash)
    rows, given = set_aside(captures, ["url", "fetched_at"], host=url_host(F.col("url")))
    hosts = rows.where(F.col("host").isNotNull()).select("host").distinct()
    period = lambda at: F.floor(F.unix_timestamp(at) / PERIOD)
    last = captures.agg(F.max(period(F.col("fetched_at")))).first()[0]
    segments = host_segments(hosts, validity(entries))
    first = period(F.col("seg_from"))
    until = F.least(F.coalesce(period(F.col("seg_to")), F.lit(last).cast("long")), F.lit(last).cast("long"))
    spread = segments.where(first <= until).select("*", F.explode(F.sequence(first, until)).alias("_period"))
    out = rows.withColumn("_period", period(F.col("fetched_at"))).alias("c").join(
        spread.withColumnRenamed("host", "_host").withColumnRenamed("_period", "_seg_period").alias("s"),
        (F.col("host") == F.col("_host")) & (F.col("_period") == F.col("_seg_period"))
        & (F.col("fetched_at") >= F.col("seg_from")) & (F.col("seg_to").isNull() | (F.col("fetched_at") < F.col("seg_to"))),
        "left",
    )
    active = F.coalesce(F.col("active_entries"), F.lit(0)).cast("long")
    return out.select(*given, "host", active.alias("active_entries"), (active > 0).alias("blocked"))


# The tables carry no fetch dates and no lists, so the query derives both from them.


def page_captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched_at): pages spread over the year 2024 by their id."""
    second = F.lit(1_704_067_200) + F.pmod(F.col("page_id") * 7919, F.lit(31_536_000))
    return pages.select("page_id", "url", F.timestamp_seconds(second).alias("fetched_at"))


def host_entries(pages: DataFrame) -> DataFrame:
    """Dated entries about the pages' hosts and all domains above them of two labels or more, drawn from digits of a digest of the name.

    Names with a first digit below 6 are added on a day of the year to one of three lists;
    two in three are removed later, and half of those come back.
    """
    hosts = pages.select(url_host(F.col("url")).alias("host")).where("host is not null").distinct()
    names = hosts.select(F.explode(parent_domains(F.col("host"))).alias("pattern")).where("pattern like '%.%'").distinct()
    digit = lambda at, many: F.conv(F.substring(F.md5("pattern"), at, many), 16, 10).cast("long")
    names = names.where(digit(1, 1) < 6).select("pattern", (digit(2, 1) % 3).alias("l"), (digit(3, 4) % 300).alias("d"), (digit(7, 2) + 1).alias("gap"), (digit(9, 1) % 3).alias("r"))
    name = F.element_at(F.array(F.lit("ads"), F.lit("malware"), F.lit("spam")), (F.col("l") + 1).cast("int"))
    day = lambda d: F.timestamp_seconds(F.lit(1_704_067_200) + d * 86_400)
    entry = lambda d, action, when: F.when(when, F.struct(day(d).alias("dated_at"), F.lit(action).alias("action")))
    d, gap, r = F.col("d"), F.col("gap"), F.col("r")
    entries = F.array(entry(d, "add", F.lit(True)), entry(d + gap, "remove", r > 0), entry(d + 2 * gap, "add", r > 1))
    return names.select(name.alias("list_name"), "pattern", F.explode(F.array_compact(entries)).alias("e")).select("list_name", "pattern", "e.dated_at", "e.action")


def op5_url_lists(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, host, fetched_at (seconds), active_entries, blocked of every page."""
    pages = pages.select("page_id", "url")
    listed = listed_captures(page_captures(pages), host_entries(pages))
    return listed.select("page_id", "host", F.unix_timestamp("fetched_at").alias("fetched_at"), "active_entries", "blocked")


OP5_SQL = r"""
WITH c AS (
  SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '') AS host,
         make_timestamp((1704067200 + ((page_id * 7919) % 31536000 + 31536000) % 31536000) * 1000000) AS fetched_at
  FROM pages
), hosts AS (SELECT DISTINCT host FROM c WHERE host IS NOT NULL),
names AS (
  SELECT DISTINCT pattern FROM (
    SELECT unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS pattern FROM (SELECT string_split(host, '.') AS labels FROM hosts)
  ) WHERE pattern LIKE '%.%'
), drawn AS (
  SELECT pattern, ['ads', 'malware', 'spam'][CAST(('0x' || substr(md5(pattern), 2, 1)) AS BIGINT) % 3 + 1] AS list_name,
         CAST(('0x' || substr(md5(pattern), 3, 4)) AS BIGINT) % 300 AS d, CAST(('0x' || substr(md5(pattern), 7, 2)) AS BIGINT) + 1 AS gap,
         CAST(('0x' || substr(md5(pattern), 9, 1)) AS BIGINT) % 3 AS r
  FROM names WHERE CAST(('0x' || substr(md5(pattern), 1, 1)) AS BIGINT) < 6
), spans AS (
  SELECT list_name, pattern, d AS f, CASE WHEN r > 0 THEN d + gap END AS t FROM drawn
  UNION ALL SELECT list_name, pattern, d + 2 * gap, NULL FROM drawn WHERE r > 1
), valid AS (
  SELECT pattern, make_timestamp((1704067200 + f * 86400) * 1000000) AS f, make_timestamp((1704067200 + t * 86400) * 1000000) AS t FROM spans
)
SELECT c.page_id, c.host, CAST(epoch(c.fetched_at) AS BIGINT) AS fetched_at, CAST(count(v.pattern) AS BIGINT) AS active_entries, count(v.pattern) > 0 AS blocked
FROM c LEFT JOIN valid v ON (c.host = v.pattern OR ends_with(c.host, '.' || v.pattern)) AND c.fetched_at >= v.f AND (v.t IS NULL OR c.fetched_at < v.t)
GROUP BY c.page_id, c.host, c.fetched_at
"""
