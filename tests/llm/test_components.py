from tidemark.llm.common import stored
from tidemark.llm.components import components


def test_stars_need_no_further_round(spark):
    kept = []

    def keep(df):
        kept.append(1)
        return stored(df, "edges")

    edges = spark.createDataFrame([(5, 1), (1, 7), (9, 1), (4, 3), (4, 4), (None, 2)], "a long, b long")
    got = sorted(map(tuple, components(edges, keep).collect()))
    assert got == [(1, 1), (3, 3), (4, 3), (5, 1), (7, 1), (9, 1)]
    assert len(kept) == 1


def test_chains_end_at_their_smallest_node(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + (7 * i) % 31, 100 + (7 * i + 7) % 31) for i in range(31)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100)}
