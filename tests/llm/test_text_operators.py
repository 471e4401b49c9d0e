import datetime as dt
import re

import numpy as np
import pytest
from llm_cases import EDGE, documents, prose
from pyspark.sql import functions as F

from tidemark.llm import language, ngram_join, toxicity, url_lists

UPPER = {c: c + 32 for c in range(65, 91)}


def brute_sets(rows):
    sets = {}
    for i, t, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    return sets


def brute_components(rows):
    """n_shingles and component of every doc_id that isn't null; rows of one id are the same text here."""
    sets = brute_sets([r for r in rows if r[0] is not None])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(base, many, edits, seed):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(many):
        words = prose(base, 120).split()
        for _ in range(edits):
            words[int(rng.integers(len(words)))] = f"new{k}x{int(rng.integers(1000))}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def crowd():
    """Near copies on both sides of the threshold, exact copies, a passage that many share."""
    texts = family(1, 25, 2, 1) + family(2, 25, 4, 2) + family(3, 10, 1, 3) + [prose(4, 80)] * 12
    passage = prose(99, 60)
    texts += [f"{prose(200 + k, 15)} {passage} {prose(300 + k, 15)}" for k in range(25)]
    texts += [prose(400 + k, 3) for k in range(5)] + ["A b C", "a B c", prose(1, 120).upper()]
    return [(100 + i, t, "en") for i, t in enumerate(texts)] + EDGE


@pytest.mark.parametrize("slice_rows", [20_000, 4])
def test_components_of_near_texts(spark, crowd, monkeypatch, slice_rows):
    monkeypatch.setattr(ngram_join, "SLICE_ROWS", slice_rows)
    got = ngram_join.op9_ngram_join(spark, documents(spark, crowd).repartition(4)).collect()
    assert len(got) == len(crowd)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == brute_components(crowd)
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}


def test_shingle_sets_do_not_depend_on_their_neighbours(monkeypatch):
    texts = [t.encode() for _, t, _ in EDGE if t] + [b"", prose(5, 50).encode()]
    together = list(ngram_join.shingle_sets(texts))
    alone = [next(ngram_join.shingle_sets([t])) for t in texts]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(together, alone))
    assert [len(s) for s in together] == [len(s) for s in brute_sets([(k, t.decode(), None) for k, t in enumerate(texts)]).values()]


def test_prefixes_of_every_order_meet(monkeypatch):
    rng = np.random.default_rng(0)
    ranks = rng.integers(0, 50, (ngram_join.ORDERS, ngram_join.BUCKETS))
    for _ in range(50):
        a = rng.integers(0, 1 << 62, 100).astype(np.uint64)
        b = np.unique(np.concatenate([a[: int(rng.integers(80, 100))], rng.integers(0, 1 << 62, 5).astype(np.uint64)]))
        a = np.unique(a)
        if ngram_join.similar(a, b):
            assert all(len(np.intersect1d(ngram_join.prefix(a, o, ranks), ngram_join.prefix(b, o, ranks))) for o in range(ngram_join.ORDERS))


def test_no_documents(spark, nothing):
    assert ngram_join.op9_ngram_join(spark, nothing).count() == 0


# --- toxicity -----------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        words, toxic = prose(i, int(rng.integers(5, 400))).split(), int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(len(words))), ("vilgrunt", "Sclorp!", "drokhead")[int(rng.integers(3))])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, toxic, 5))
    labels += [(None, 1, 1, 5), (3, 1, None, 5), (10_000, 0, 1, 5), (4, 1, 1, 5)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score int")


def test_held_out_documents_are_told_apart(spark, labelled):
    docs, labels = labelled
    scored = toxicity.op6_toxicity(spark, docs, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = [(r["doc_id"] % 4 == 0, r["predicted"], r["held_out"]) for r in scored.collect()]
    held = [(t, p) for t, p, h in rows if h]
    assert len(rows) == 300 and len(held) > 30
    assert sum(t == bool(p) for t, p in held) >= 0.95 * len(held)


def test_scores_of_odd_texts(spark, labelled, edge, nothing):
    net = toxicity.fit(*labelled)
    got = toxicity.score_documents(edge, net)
    assert {"host", "length", "token"} <= set(got.columns) and dict(got.dtypes)["score"] == "double"
    rows = got.collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert {r["score"] for r in rows if not (r["text"] or "").split()} == {0.0}
    assert toxicity.score_documents(nothing, net).count() == 0
    hidden = documents(spark, [(1, prose(1, 5000) + " vilgrunt sclorp drokhead " + prose(2, 5000), "en"), (2, prose(1, 10_000), "en")])
    assert [r["predicted"] for r in toxicity.score_documents(hidden, net).orderBy("doc_id").collect()] == [1, 0]
    kept = toxicity.keep_clean(hidden, net)
    assert kept.columns == hidden.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_without_labels_all_is_clean(spark, edge):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in toxicity.op6_toxicity(spark, edge, labels).collect()} == {0}


def test_windows_cover_the_text():
    for size in (1, 63, 64, 65, 96, 97, 1000):
        starts = toxicity.window_starts(size)
        assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= size and all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:]))
    assert toxicity.window_starts(0) == []


def test_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh({f"w{i}": 0.3 for i in range(9)})
    net.weights = {k: v.astype(float) + 0.1 * rng.standard_normal(v.shape) for k, v in net.weights.items()}
    names, label = [f"w{i}" for i in range(12)], np.array([1, 0, 1.0])
    codes, mask = rng.integers(0, 12, (6, 3)), np.arange(6)[:, None] < np.array([6, 2, 4])

    def loss():
        logit = net.logits(codes, mask, net.projected(names)).astype(float)
        return np.mean(np.logaddexp(0, logit) - label * logit)

    for name, g in net.gradients(codes, mask, names, label).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value = net.weights[name][at]
        net.weights[name][at] = value + 1e-3
        above = loss()
        net.weights[name][at] = value - 1e-3
        below = loss()
        net.weights[name][at] = value
        assert g[at] == pytest.approx((above - below) / 2e-3, rel=0.05, abs=1e-5)


# --- language -----------------------------------------------------------------

TAUGHT = {"en": "the house and the river with this thing which", "de": "das haus und der fluss mit diesem ding welches", "fr": "la maison et le fleuve avec cette chose laquelle"}


@pytest.fixture(scope="module")
def model(spark):
    return language.fit_trigrams(documents(spark, [(i, " ".join(w.split()[i % 5 :]), k) for i in range(30) for k, w in TAUGHT.items()]))


def page(body, lang=None):
    return f"<html{f' lang={chr(34)}{lang}{chr(34)}' if lang else ''}><head><script>let x='der die das'</script></head><body>{body}</body></html>"


PAGES = [
    (1, "http://a.example.de/x", page("the house and the river with this", "en")), (2, "http://a.example.de/y", page("das haus und der fluss")),
    (3, "http://a.example.de/z", page("123", None)), (4, "http://b.example.de/", page("", "fr")), (5, None, page("la maison et le fleuve")),
    (6, "http://c.org/", None), (None, None, None), (6, "http://c.org/", None), (8, "http://a.example.de/", page("der", "xx")),
]


def brute_fusion(model, rows):
    """The same evidence, added up a page at a time."""
    n, texts, hosts = len(model.languages), {}, {}
    for k, (_, url, html) in enumerate(rows):
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", html or "")
        bare = re.sub(r"&[a-zA-Z#0-9]+;", " ", re.sub(r"(?s)<[^>]*>", " ", bare))
        s = model.log_likelihood(bare)
        texts[k] = None if s is None else np.maximum(language.softmax(s), 1e-12)
        hosts[k] = re.match(r"[a-z]+://([^/]+)", url)[1] if url else None
    level = lambda test: sum((p for k, p in texts.items() if p is not None and hosts[k] is not None and test(hosts[k])), np.zeros(n))
    total = level(lambda h: True)
    even = (total + 1) / (total.sum() + n)
    pull = lambda sums, parent: (sums + language.STRENGTH * parent) / (sums.sum() + language.STRENGTH)
    out = []
    for k, (i, _, html) in enumerate(rows):
        h, prior, nation = hosts[k], even, None
        if h is not None:
            suffix, domain = h.split(".")[-1], ".".join(h.split(".")[-2:])
            nation = language.SUFFIX_LANGUAGE.get(suffix)
            if level(lambda x: x == h).sum():
                prior = pull(level(lambda x: x == h), pull(level(lambda x: ".".join(x.split(".")[-2:]) == domain), pull(level(lambda x: x.split(".")[-1] == suffix), even)))
        declared = re.search(r'<html lang="([a-z]+)', html or "")
        score = np.log(prior) + (0 if texts[k] is None else np.log(texts[k]))
        for claim in (declared and declared[1], nation):
            if claim in model.languages:
                score = score + [np.log(language.TRUST if x == claim else (1 - language.TRUST) / (n - 1)) for x in model.languages]
        p = language.softmax(score)
        out.append((i, model.languages[int(p.argmax())], float(p.max())))
    return out


def test_fusion_against_a_page_at_a_time(spark, model):
    pages = spark.createDataFrame([(*r, "clash", 1.0) for r in PAGES], "page_id long, url string, html string, declared string, prior double")
    got = sorted(((r["page_id"], r["language"], r["probability"]) for r in language.fuse(pages, model).collect()), key=repr)
    want = sorted(brute_fusion(model, PAGES), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-6)


def test_texts_without_letters_are_rejected(spark, model, edge, nothing):
    found = {r["doc_id"]: (r["predicted_lang"], r["lang_prob"]) for r in language.detect(edge, model).where("doc_id is not null").collect()}
    assert found[2] == found[3] == found[11] == (None, None) and found[1][0] in model.languages
    kept = language.keep_identified(edge, model)
    assert kept.columns == edge.columns
    assert not {2, 3, 11, 12} & {r["doc_id"] for r in kept.collect()}
    assert language.keep_identified(nothing, model).count() == 0 and language.fuse(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_model_without_languages(spark, edge, nothing):
    blank = language.fit_trigrams(nothing)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert {r["language"] for r in language.fuse(pages, blank).collect()} == {None}
    assert language.keep_identified(edge, blank).count() == edge.count()


def test_rare_languages_are_in_the_sample(spark):
    rare = [(1000 + i, f"{w} {w}", w[:2]) for i, w in enumerate(("zuvo", "kyme", "xape", "qiro", "jadu"))]
    docs = documents(spark, [(i, f"the house and the river {'abcdefgh'[i % 8]}{'ijklmnop'[i // 8 % 8]}", "en") for i in range(400)] + rare)
    assert language.fit_trigrams(docs, sample=20).languages == sorted(["en", *(k for _, _, k in rare)])


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    right = language.detect(docs, language.fit_trigrams(docs.where("doc_id % 2 = 0"))).where("doc_id % 2 = 1")
    assert right.agg(F.avg((F.col("lang") == F.col("predicted_lang")).cast("double"))).first()[0] > 0.97


# --- address lists --------------------------------------------------------------

DAY = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
ENTRIES = [
    ("ads", "Bad.com", DAY(10), "add"), ("ads", "bad.com", DAY(50), "remove"), ("ads", "bad.com", DAY(70), "add"), ("spam", "www.bad.com", DAY(20), "add"),
    ("spam", "bad.com", DAY(30), "add"), ("spam", "bad.com", DAY(30), "remove"), ("ads", "com.com", DAY(0), "add"), ("ads", "com.com", DAY(5), "add"),
    (None, "bad.com", DAY(1), "add"), ("ads", None, DAY(1), "add"), ("ads", "bad.com", None, "add"), ("ads", "bad.com", DAY(12), "odd"), ("ads", "x.org", DAY(40), "remove"),
]
URLS = ["http://www.bad.com/a", "https://user:p@BAD.com:8080/x?y", "http://notbad.com", "http://a.b.com.com/", "http://x.org", None, "", "nonsense", "http://", "ftp://bad.com"]


def test_captures_as_of_their_time(spark):
    captures = [(k, u, DAY(d), 7, "mine") for d in (0, 5, 10, 19, 20, 30, 49, 50, 60, 70, 400) for k, u in enumerate(URLS)] + [(1, URLS[0], None, 7, "mine")]
    df = spark.createDataFrame(captures * 2, "page_id long, url string, fetched_at timestamp, active_entries int, host string")
    entries = spark.createDataFrame(ENTRIES, "list_name string, pattern string, dated_at timestamp, action string")
    got = url_lists.listed_captures(df, entries).collect()
    assert len(got) == len(captures) * 2
    spans = [("bad.com", DAY(10), DAY(50)), ("bad.com", DAY(70), None), ("www.bad.com", DAY(20), None), ("com.com", DAY(0), DAY(5)), ("com.com", DAY(5), None)]
    for r in got:
        m = re.match(r"[a-z]+://(?:[^/@]*@)?([^/:?#]+)", (r["url"] or "").lower())
        host, at = m and m[1], r["fetched_at"]
        want = 0 if host is None or at is None else sum((host == p or host.endswith("." + p)) and at >= f and (t is None or at < t) for p, f, t in spans)
        assert (r["host"], r["active_entries"], r["blocked"]) == (host, want, want > 0)


def test_no_captures_or_entries(spark):
    none = spark.createDataFrame([], "list_name string, pattern string, dated_at timestamp, action string")
    df = spark.createDataFrame([(1, "http://a.b", DAY(1))], "page_id long, url string, fetched_at timestamp")
    assert [r["active_entries"] for r in url_lists.listed_captures(df, none).collect()] == [0]
    assert url_lists.listed_captures(df.limit(0), none).count() == 0
    assert url_lists.op5_url_lists(spark, spark.createDataFrame([(1, None, "x"), (None, "http://a.b.c", None)], "page_id long, url string, html string")).count() == 2


def test_query_runs_no_python(spark, sf_dir):
    df = url_lists.op5_url_lists(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_parity_bits_never_part_what_links():
    """Bits that differ are tokens of one set only, so sets that link differ in (n + m) / 9 bits at most."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(5, 900))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[int(rng.integers(0, n // 4 + 1)) :], rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        apart = sum(bin(x ^ y).count("1") for x, y in zip(ngram_join.parity(a), ngram_join.parity(b)))
        assert apart <= len(np.setxor1d(a, b))
        if ngram_join.similar(np.unique(a), np.unique(b)):
            assert 9 * apart <= len(a) + len(b)


def plain_score(net, text):
    """One window after the other, one word after the other: the worst window's logit."""
    w = {k: v.astype(float) for k, v in net.weights.items()}
    sigma = lambda x: 1 / (1 + np.exp(-x))
    h = toxicity.HIDDEN

    def word_input(word):
        word = word.strip(toxicity.MARKS) or "."
        padded, slots = f" {word} ", []
        for k in range(len(word)):
            a, b, c = (ord(x) for x in padded[k : k + 3])
            mixed = (a * 0x9E3779B1) ^ (b * 0x85EBCA77) ^ (c * 0xC2B2AE3D)
            slots.append((mixed ^ mixed >> 13) % toxicity.CHAR_SLOTS)
        return np.concatenate([w["word"][net.words.get(word, 0)], np.mean([w["char"][s] for s in slots], axis=0)])

    def states(inputs, d):
        state, out = np.zeros(h), []
        for x in inputs:
            gates = x @ w[f"{d}W"] + w[f"{d}b"]
            zr = sigma(gates[: 2 * h] + state @ w[f"{d}U"])
            candidate = np.tanh(gates[2 * h :] + (zr[h:] * state) @ w[f"{d}V"])
            state = (1 - zr[:h]) * state + zr[:h] * candidate
            out.append(state)
        return out

    words, worst = text.lower().split(), -np.inf
    for start in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE) if words else ():
        inputs = [word_input(x) for x in words[start : start + toxicity.WINDOW]]
        both = [np.concatenate(pair) for pair in zip(states(inputs, "f"), states(inputs[::-1], "b")[::-1])]
        attention = np.exp([np.tanh(s @ w["A"]) @ w["a"] for s in both])
        context = sum(share * s for share, s in zip(attention / attention.sum(), both))
        worst = max(worst, context @ w["o"] + w["p"][0])
    return worst


def test_scores_equal_a_plain_pass_over_every_window():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(40)] + ["ça", "日本", "...", "don't!", "x"]
    net = toxicity.Network.fresh({w: float(rng.normal()) for w in vocabulary[:30]}, {i: 0.4 for i in range(0, toxicity.CHAR_SLOTS, 7)})
    net.weights["p"][:] = 0.3
    sizes = (0, 1, 2, 31, 33, 63, 64, 65, 95, 96, 97, 128, 129, 200)
    all_texts = [" ".join(rng.choice(vocabulary, n)) for n in sizes]
    got, want = net.scores(all_texts), np.array([plain_score(net, t) for t in all_texts])
    assert got[0] == want[0] == -np.inf and np.allclose(got[1:], want[1:], atol=2e-3)
