"""Merkle manifest of a table: a tree of digests per group, their roots under one more tree.

A leaf is the digest of a row. Within a group leaves are put in order and numbered, and every
level finds its runs by sibling shifts: a node at ``i`` looks for the nodes of its run by
equijoins on computed numbers (``i`` XOR 1 with two a run, else ``i`` shifted by each slot
offset within the run). The rows of slot 0 then hold a whole run and emit its parent, numbered
``i`` div arity. A level is written to the shared folder, so a lost executor costs a level.

Proofs go the other way: a node's proof is its siblings followed by its parent's proof, one
equijoin on the parent's number per level. All joins are on (group, number), which is unique,
so a group with a third of all rows is as spread as any other. Numbers come from one range
sort and the row counts of its partitions; no window runs over a group.

The tree over the groups is the same once more, with the subroots as leaves.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, stored

#: A step of a proof is one number: the node's slot times this, plus the number of its siblings.
STEP = 128
#: Levels whose proofs are joined before they are written.
STRIDE = 4
#: Spark's row numbers count up from 0 within partitions numbered above this bit (fixed value).
PART_BIT = 33


def digest(raw: Column) -> Column:
    """Binary SHA-256 of the lowercase hex text of ``raw``, which holds binary digests in a row."""
    return F.unhex(F.sha2(F.lower(F.hex(raw)), 256))


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value: no two rows read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(columns: Mapping[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns.values())), 256))


def text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def numbered(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Rows (team, key, h, claim) as kept (g, i, n, h, key, claim).

    ``i`` counts from 0 within the team by key, then digest; ``n`` is the team's size and ``g``
    stands for it: the number of its first row among all. Null teams and keys come first.
    """
    order = ["team", "key", "h", "tie"]
    sorted_ = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = scratch.keep(sorted_.select("team", "key", "h", "claim", F.monotonically_increasing_id().alias("at")))
    part, place = F.shiftright("at", PART_BIT), F.col("at").bitwiseAND((1 << PART_BIT) - 1)
    # One row per partition and team: a few more than there are partitions, or teams.
    runs = scratch.keep(sorted_.groupBy(part.alias("part"), "team").agg(F.min(place).alias("first"), F.count("*").alias("rows")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = runs.groupBy("part").agg(F.sum("rows").alias("all")).select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("skip"))
    runs = runs.join(parts, "part")
    teams = runs.groupBy("team").agg(F.min(F.col("skip") + F.col("first")).alias("g"), F.sum("rows").alias("n"))
    runs = runs.alias("r").join(teams.alias("t"), F.col("r.team").eqNullSafe(F.col("t.team"))).select(
        F.col("part").alias("in_part"), F.col("r.team").alias("in_team"), "skip", "g", "n"
    )
    met = sorted_.join(scratch.keep(runs), (part == F.col("in_part")) & F.col("team").eqNullSafe(F.col("in_team")))
    return scratch.keep(met.select("g", (F.col("skip") + place - F.col("g")).alias("i"), "n", "h", "key", "claim"))


def siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node with ``o``, its siblings' digests from left to right, and ``step`` (see STEP)."""
    slot = F.col("i") % arity
    met, found = nodes, []
    for shift in range(1, arity):
        at = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("i") - slot + (slot + shift) % arity
        other = nodes.select(F.col("g").alias(f"g{shift}"), F.col("i").alias(f"i{shift}"), F.col("h").alias(f"h{shift}"))
        met = met.join(other, (F.col("g") == F.col(f"g{shift}")) & (at == F.col(f"i{shift}")), "left")
        found.append((slot + shift >= arity, F.col(f"h{shift}")))
    none = F.lit(b"")
    lefts = [F.when(wrapped, F.coalesce(h, none)).otherwise(none) for wrapped, h in found]
    rights = [F.when(~wrapped, F.coalesce(h, none)).otherwise(none) for wrapped, h in found]
    many = sum((h.isNotNull().cast("int") for _, h in found), F.lit(0))
    return met.select(*nodes.columns, F.concat(*lefts, *rights).alias("o"), (slot * STEP + many).cast("smallint").alias("step"))


def forest(scratch: Scratch, leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels below the tops, each with siblings; and the tops (level, g, i, n, h, key, claim)."""
    current, levels, tops, size = leaves, [], [], leaves.agg(F.max("n")).first()[0] or 1
    while True:
        tops.append(current.where("n = 1").select(F.lit(len(levels)).alias("level"), *leaves.columns))
        if size <= 1:
            break
        levels.append(scratch.keep(siblings(current.where("n > 1"), arity)))
        current = levels[-1].where(F.col("step") < STEP).select(
            "g", F.expr(f"i div {arity}").alias("i"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), digest(F.concat("h", "o")).alias("h"),
            *(F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in ("key", "claim")),
        )
        size = -(-size // arity)
    return levels, scratch.keep(reduce(DataFrame.union, tops))


def proofs(scratch: Scratch, levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """Leaves with ``subroot`` and their whole proof: ``steps``, ``others``. ``tops`` bring their own proofs along."""
    out = ["g", "i", "h", "key", "claim", "subroot", "steps", "others"]
    below = tops.where(F.col("level") == len(levels)).select(out)
    for depth in reversed(range(len(levels))):
        above = below.select(F.col("g").alias("ag"), F.col("i").alias("ai"), F.col("steps").alias("a_steps"), F.col("others").alias("a_others"), "subroot")
        met = levels[depth].join(above, (F.col("g") == F.col("ag")) & (F.expr(f"i div {arity}") == F.col("ai")))
        grown = met.select(
            "g", "i", "h", "key", "claim", "subroot", F.concat(F.array("step"), "a_steps").alias("steps"), F.concat("o", "a_others").alias("others")
        )
        below = grown.union(tops.where(F.col("level") == depth).select(out))
        if depth % STRIDE == 0:
            below = scratch.keep(below)
    return below


def folded(claim: Column, steps: Column, others: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    width = 32

    def step(state: Column, way: Column) -> Column:
        slot, many = F.floor(way / STEP).cast("int"), (way % STEP).cast("int")
        left = F.substr(others, state["at"] + 1, slot * width)
        right = F.substr(others, state["at"] + 1 + slot * width, (many - slot) * width)
        return F.struct(digest(F.concat(left, state["h"], right)).alias("h"), (state["at"] + many * width).alias("at"))

    return F.aggregate(steps, F.struct(claim.alias("h"), F.lit(0).alias("at")), step, lambda state: state["h"])


def merkle_manifest(
    table: DataFrame, columns: list[str], group: str, key: str, arity: int = 2, presented: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``table``: key, leaf, claim, subroot, root, steps, others; digests binary.

    ``columns`` are hashed into the leaf, in this order. ``presented`` gives columns of the rows
    as somebody presents them, to be verified: ``claim`` is their leaf, else the leaf itself.
    ``steps`` and ``others`` are the proof: per level the node's slot and how many siblings it
    has, and all siblings' digests in a row. ``folded(claim, steps, others)`` has to be ``root``.

    Null groups are a group of their own and come first, as null keys do. Rows with equal keys
    go by their digests, so the tree doesn't depend on the order of the input; repeated rows
    are leaves of their own. An empty table gives no rows. Other columns are not looked at.
    """
    if not 2 <= arity < STEP:
        raise ValueError(f"arity {arity}")
    own = {c: F.col(c) for c in columns}
    claim = F.lit(None).cast("binary")
    if presented:
        claim = row_digest({**own, **presented})
        claim = F.when(claim != row_digest(own), claim)
    spark = table.sparkSession
    with Scratch(spark, "merkle") as scratch:
        rows = scratch.keep(table.select(F.col(group).alias("team"), F.col(key).alias("key"), row_digest(own).alias("h"), claim.alias("claim")))
        levels, tops = forest(scratch, numbered(scratch, rows), arity)
        teams = tops.select(F.lit(0).alias("team"), F.col("g").alias("key"), "h", F.lit(None).cast("binary").alias("claim"))
        team_levels, summit = forest(scratch, numbered(scratch, teams), arity)
        root = summit.first()
        ends = [F.col("h").alias("subroot"), F.array().cast("array<smallint>").alias("steps"), F.lit(b"").alias("others")]
        ways = proofs(scratch, team_levels, summit.select("*", *ends), arity).select(F.col("key").alias("tg"), "steps", "others")
        tops = scratch.keep(tops.join(ways, F.col("g") == F.col("tg")).select("level", "g", "i", "h", "key", "claim", F.col("h").alias("subroot"), "steps", "others"))
        found = proofs(scratch, levels, tops, arity)
        return stored(found.select(
            "key", F.col("h").alias("leaf"), F.coalesce("claim", "h").alias("claim"), "subroot", F.lit(root["h"] if root else None).cast("binary").alias("root"), "steps", "others"
        ), "merkle-manifest")


def op11_merkle(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Manifest of the documents by language, each row verified as a tamperer of every seventh presents it."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    presented = {"n_chars": F.col("n_chars") + F.when(tampered, 1).otherwise(0)}
    rows = merkle_manifest(documents, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", presented=presented)
    again = folded(F.col("claim"), F.col("steps"), F.col("others"))
    rows = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "others", again.alias("folded"))
    return rows.select(
        "doc_id", text(F.col("leaf")).alias("leaf"), text(F.col("subroot")).alias("subroot"), text(F.col("root")).alias("root"),
        F.sha2(text(F.col("others")), 256).alias("proof_sha256"), text(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


#: The same tree in SQL: recursive levels, siblings found by XOR, proofs folded leaf by leaf.
OP11_SQL = """
WITH RECURSIVE
rows_ AS (
  SELECT doc_id, lang, n_chars,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: k::UBIGINT)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) AS crc
  FROM documents
),
leaves AS (
  SELECT doc_id, lang,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' WHEN crc % 7 = 0 THEN strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS claim
  FROM rows_
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
),
up AS (
  SELECT 0 AS lvl, lang, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT lvl + 1, lang, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lvl, lang, i // 2
),
subroots AS (SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, t AS i, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 2
),
way AS (
  SELECT doc_id, p.lang, p.i, p.leaf, s.h AS subroot, s.height, s.t, 0 AS lvl, claim AS h, '' AS sibs FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, w.lang, w.i, leaf, subroot, height, t, w.lvl + 1,
    sha256(CASE WHEN u.h IS NULL THEN w.h WHEN (w.i >> w.lvl) % 2 = 0 THEN w.h || u.h ELSE u.h || w.h END), sibs || coalesce(u.h, '')
  FROM way w LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM w.lang AND u.lvl = w.lvl AND u.i = xor(w.i >> w.lvl, 1)
  WHERE w.lvl < height
),
far AS (
  SELECT doc_id, leaf, subroot, t, 0 AS lvl, h, sibs FROM way WHERE lvl = height
  UNION ALL
  SELECT doc_id, leaf, subroot, t, f.lvl + 1,
    sha256(CASE WHEN u.h IS NULL THEN f.h WHEN (t >> f.lvl) % 2 = 0 THEN f.h || u.h ELSE u.h || f.h END), sibs || coalesce(u.h, '')
  FROM far f LEFT JOIN top u ON u.lvl = f.lvl AND u.i = xor(t >> f.lvl, 1) WHERE f.lvl < (SELECT max(lvl) FROM top)
)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(sibs) AS proof_sha256, h AS folded_root, h = (SELECT h FROM top WHERE n = 1) AS verified
FROM far WHERE lvl = (SELECT max(lvl) FROM top)
"""
