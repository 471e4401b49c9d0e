import numpy as np
import pytest

from tidemark.llm import cross_polytope, itq
from tidemark.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, code string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2) for r in rows], SCHEMA).repartition(3)


def crowd(n=300, d=16, seed=3):
    """Vectors of which a third lie close to a few others."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    near = rng.integers(0, 5, n)
    close = rng.random(n) < 0.4
    x[close] = x[near[close]] + 0.12 * rng.standard_normal((close.sum(), d))
    return x.astype(np.float32), near % 2


ODD = [
    (900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [None] + [1.0] * 15, 0), (904, [float("inf")] + [0.0] * 15, 0),
    (905, [], 0), (906, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (907, [1.0] * 16, None), (908, [1.0] * 16, None),
]


@pytest.fixture(scope="module")
def vectors(spark):
    x, label = crowd()
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    rows += [(500, rows[7][1], rows[7][2]), (501, rows[7][1], rows[7][2]), rows[9]]
    return rows


def links(rows, threshold=0.93):
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and len(r[1]) == 16 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    x = np.array([r[1] for r in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label, ids = np.array([r[2] for r in good]), np.array([r[0] for r in good])
    hit = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    return ids, hit


@pytest.mark.parametrize("block", [1024, 16])
def test_near_copies_against_all_pairs(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(itq, "BLOCK", block)
    rows = vectors + ODD
    got = itq.op3_itq_near_copies(spark, frame(spark, rows)).collect()
    assert len(got) == len(rows)
    ids, hit = links(rows)
    root = ids.copy()
    while True:
        new = np.array([min([root[k], *root[hit[k]]]) for k in range(len(ids))])
        if (new == root).all():
            break
        root = new
    want = {i: (int(n), int(r)) for i, n, r in zip(ids, hit.sum(axis=1), root)}
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    total, missing = sum(n for n, _ in want.values()), 0
    for i, (n, _) in want.items():
        assert found[i][0] <= n
        missing += n - found[i][0]
    assert missing <= 0.1 * total
    for i, *_ in ODD:
        assert found[i] == (0, i)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)


def test_rotation_balances_bits():
    x, _ = crowd(600)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    mean, projection = itq.learn_rotation(x.astype(float), 16)
    share = ((x - mean) @ projection >= 0).mean(axis=0)
    assert (share > 0.1).all() and (share < 0.9).all()
    assert np.allclose(projection.T @ projection, np.eye(16), atol=1e-6)


def brute(rows, k=20, every=20):
    best = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            best[i] = np.array(v, np.float64)
    out = {}
    for q in best:
        if q % every == 0:
            out[q] = sorted(((-float((best[q] * v).sum()), i) for i, v in best.items() if i != q))[:k]
    return out


@pytest.mark.parametrize("scale", [1, 3])
def test_neighbours_against_all_vectors(spark, vectors, monkeypatch, scale):
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    rows = [(i, [float(np.float32(x * (1 + (i % scale)))) for x in v], k) for i, v, k in vectors] + ODD
    got, want = {}, brute(rows)
    for r in cross_polytope.op4_cross_polytope(spark, frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = 0
    exact = {(q, i): -s for q, near in brute(rows, k=10**6).items() for s, i in near}
    for q, near in want.items():
        ranked = sorted(got[q])
        assert [r for r, _, _ in ranked] == list(range(1, len(near) + 1))
        assert [(-s, i) for _, i, s in ranked] == sorted((-s, i) for _, i, s in ranked)
        assert all(abs(exact[q, i] - s) < 1e-9 for _, i, s in ranked)
        hits += len({i for _, i in near} & {i for _, i, _ in ranked})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0)]
    got = cross_polytope.op4_cross_polytope(spark, frame(spark, rows)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2)]


@pytest.mark.parametrize("scale", ["one long", "spread"])
def test_neighbours_of_lengths_that_differ(spark, scale):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale == "one long":
        x[5] *= 10
    else:
        x *= np.exp(0.3 * rng.standard_normal((len(x), 1)))
    x = x.astype(np.float32)
    got = {}
    for r in cross_polytope.op4_cross_polytope(spark, frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    assert sorted(got) == list(range(0, 3000, 20)) and {len(v) for v in got.values()} == {20}
    assert sum(len(got[q] & set(np.argsort(-scores[q])[:20].tolist())) for q in got) >= 0.95 * 20 * len(got)


@pytest.mark.parametrize("n", [10, 20, 25])
def test_no_query_loses_rows_of_a_small_table(spark, monkeypatch, n):
    """Few vectors are hashed like many, and the queries that found too few are asked again."""
    monkeypatch.setattr(cross_polytope, "BLOCK", 7)
    x = np.random.default_rng(n).standard_normal((n, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    got = cross_polytope.op4_cross_polytope(spark, frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).collect()
    for q in range(0, n, 20):
        assert sorted(r["rank"] for r in got if r["query_id"] == q) == list(range(1, min(20, n - 1) + 1))
        assert len({r["vec_id"] for r in got if r["query_id"] == q} - {q}) == min(20, n - 1)


def test_empty_tables(spark):
    assert itq.op3_itq_near_copies(spark, frame(spark, [])).count() == 0
    assert cross_polytope.op4_cross_polytope(spark, frame(spark, [])).count() == 0
    only_odd = itq.op3_itq_near_copies(spark, frame(spark, ODD)).collect()
    assert {r["n_links"] for r in only_odd} == {0} and len(only_odd) == len(ODD)


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).standard_normal((5, 64))
    assert np.allclose((cross_polytope.hadamard(x) ** 2).sum(axis=1), (x**2).sum(axis=1))


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 3), (5, 4)], [(k, k + 1) for k in range(60)], [(9, k) for k in range(9)], [(3, 1), (3, 2), (7, 8), (8, 3), (None, 4)],
])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in root:
        for a, b in edges:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


@pytest.mark.parametrize("width", [3, 16, 40])
def test_short_vectors_find_their_near_copies(spark, width):
    """Codes have as many bits, however few coordinates there are: planted pairs of cosine 0.94 to 0.97 are found."""
    rng = np.random.default_rng(width)
    base = rng.standard_normal((150, width))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((150, width))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.94, 0.97, (150, 1))
    every = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(every)], "vec_id long, embedding array<double>, label string")
    links = {r["vec_id"]: r["n_links"] for r in itq.itq_links(df).collect()}
    near = every @ every.T >= 0.93
    want = near.sum(axis=1) - 1
    assert len(links) == 300 and sum(links.values()) >= 0.9 * want.sum() and all(links[i] <= want[i] for i in range(len(every)))
