import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_cases import EDGE, prose
from tokenizers import Tokenizer

from tidemark.llm import packing, pieces, prefix_counts, token_store
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.tokens import encoder

WORD, BYTE, PIECE = map(tokenizer_path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [t or "" for _, t, _ in EDGE] + [prose(s, 200) for s in range(5)]


@pytest.fixture(scope="module")
def libraries():
    return {path: Tokenizer.from_file(path) for path in (WORD, BYTE)}


def library_ids(library, text, end=2):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_librarys_ids(libraries, path):
    ours = encoder(path)
    for text in TEXTS * 2:  # the second time from the cache
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == libraries[path].encode(text, add_special_tokens=False).ids


def test_a_full_cache_is_emptied(libraries):
    small = type(encoder(BYTE))(BYTE, limit=50)
    for text in TEXTS:
        assert np.frombuffer(small.encode(text), "<u2").tolist() == libraries[BYTE].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7], list(range(0, 70_000, 7))])
def test_variable_length_coding_round_trip(ranks):
    control, data = token_store.encode_ids(np.array(ranks, "<u4"))
    assert len(control) == -(-len(ranks) // 4)
    assert token_store.decode_ids(control, data, len(ranks)).tolist() == ranks


def test_damaged_block_is_noticed():
    block = bytearray(token_store.pack_block([1, None], [2, 1], np.array([5, 6, 7], "<u4")) + b"\n")
    (docs, counts, ranks), = token_store.unpack_blocks(bytes(block))
    assert (docs, counts.tolist(), ranks.tolist()) == ([1, None], [2, 1], [5, 6, 7])
    block[-7] ^= 1
    with pytest.raises(ValueError):
        list(token_store.unpack_blocks(bytes(block)))


def test_store_keeps_order_and_ids(spark, edge, libraries, monkeypatch):
    monkeypatch.setattr(token_store, "PART_IDS", 5000)
    got = sorted(map(tuple, token_store.op1_token_store(spark, edge, WORD).collect()), key=lambda r: r[1])
    want = Counter((i, zlib.crc32(library_ids(libraries[WORD], t).tobytes())) for i, t, _ in EDGE)
    assert Counter((r[0], r[3]) for r in got) == want
    assert [r[0] for r in got] == sorted((i for i, _, _ in EDGE), key=lambda i: (i is not None, i or 0))
    at = 0
    for _, start, count, _ in got:
        assert start == at
        at += count


def test_store_gives_the_ids_back(spark, edge, libraries, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(edge, WORD, 2, path)
    rows = token_store.read_store(spark, path).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter((i, tuple(library_ids(libraries[WORD], t).tolist())) for i, t, _ in EDGE)


def test_pieces_equal_the_library_and_cover_the_text(spark, edge):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter()
    for i, t, _ in EDGE:
        ids = [*library.encode(t or ""), 2]
        want[i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), len((t or "").encode())] += 1
    assert Counter(map(tuple, pieces.op2_pieces(spark, edge, PIECE).collect())) == want


def test_spans_are_those_of_the_pieces(spark, edge):
    encoded = pieces.encode_pieces(edge.where("doc_id = 1"), PIECE)
    row, model = encoded.first(), pieces.piece_model(PIECE).library
    raw, bounds = EDGE[0][1].encode(), row["bounds"]
    for k, i in enumerate(row["ids"][:-1]):
        assert raw[bounds[k] : bounds[k + 1]].decode() == model.id_to_piece(i).replace("▁", " ").lstrip(" " if k == 0 else "")
    assert pieces.decode_pieces(encoded, PIECE).first()["text"] == EDGE[0][1]


def test_character_map_normalises_like_the_library():
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    proto = model_pb2.ModelProto()
    proto.ParseFromString(normaliser.serialized_model_proto())
    ours = pieces.PieceModel.__new__(pieces.PieceModel)
    ours.map, ours.collapse = pieces.CharacterMap(proto.normalizer_spec.precompiled_charsmap), True
    for text in ("Ｈｅｌｌｏ　①②  ㍿ ﬁ é", "  á  b  ", "日本 ｶﾞ​ x", "plain", "   "):
        done, source = ours.normalise(text)
        assert done.decode() == normaliser.normalize(text)
        assert len(source) == len(done) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


def test_counts_at_every_prefix(libraries):
    ours = prefix_counts.counter(BYTE)
    for text in [t[:300] for t in TEXTS] + ["    lots   of\n\n\n   space \n", "a<|endoftext|><|endoftext|> b", "!!'re we're it've"]:
        places = np.cumsum([0] + [len(c.encode()) for c in text])
        want = [len(libraries[BYTE].encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert ours.counts(text)[places].tolist() == want


def test_token_count_report(spark, edge, libraries):
    got = Counter(tuple(r)[:4] for r in prefix_counts.op8_token_counts(spark, edge, BYTE).collect())
    counted = [(i, t or "", len(libraries[BYTE].encode(t or "", add_special_tokens=False).ids)) for i, t, _ in EDGE]
    assert got == Counter((i, len(t.encode()), n, n > 1024) for i, t, n in counted)


def test_longest_prefix_within_a_budget():
    counts = np.array([0, 1, 1, 2, 3, 2, 3])
    assert [prefix_counts.longest_prefix(counts, b) for b in (0, 1, 2, 3)] == [0, 2, 3, 6]


@pytest.mark.parametrize("histogram", [{}, {1024: 3}, {600: 10, 424: 4, 500: 5}, {1: 5000}, {i: i % 7 for i in range(1, 1025)}, {341: 7, 342: 2}])
def test_plan_uses_every_piece_once(histogram):
    histogram = {k: v for k, v in histogram.items() if v}
    made, used = packing.plan(histogram), Counter()
    for lengths, many in made:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] += many
    assert used == Counter(histogram)


def test_complements_of_one_two_and_three():
    one = sum(n for _, n in packing.plan({1000: 2, 24: 2}))
    two = sum(n for _, n in packing.plan({700: 2, 200: 2, 124: 2}))
    three = sum(n for _, n in packing.plan({600: 1, 200: 1, 120: 1, 104: 1}))
    assert (one, two, three) == (2, 2, 1)


def test_packed_sequences_are_gapless(spark, edge, libraries, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 2)
    rows = packing.op10_packing(spark, edge, BYTE).collect()
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    want = {}
    for i, t, _ in EDGE:
        ids = library_ids(libraries[BYTE], t)
        first, at = len(ids) % 1024 or 1024, 0
        for k, end in enumerate(range(first, len(ids) + 1, 1024)):
            want.setdefault(i, []).append((k, at, end - at, zlib.crc32(ids[at:end].tobytes())))
            at = end
    assert {k: sorted(v) for k, v in documents.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty_tables(spark, nothing):
    for df in (
        token_store.op1_token_store(spark, nothing, WORD), pieces.op2_pieces(spark, nothing, PIECE),
        prefix_counts.op8_token_counts(spark, nothing, BYTE), packing.op10_packing(spark, nothing, BYTE),
    ):
        assert df.count() == 0


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_plain_words_take_the_librarys_model_only(libraries, path, monkeypatch):
    ours = type(encoder(path))(path)
    rng = np.random.default_rng(5)
    letters = list("abzAZsTtrevmld'''éèßàÿÀÞöø09.,!-~$×÷") + ["\n", "\n\n", "'ll", " ", " "]
    for text in ["x " + "".join(rng.choice(letters, 200)) for _ in range(60)]:
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == libraries[path].encode(text, add_special_tokens=False).ids

    class FirstWordOnly:
        def encode(self, text, add_special_tokens):
            assert text == "x"
            return libraries[path].encode(text, add_special_tokens=add_special_tokens)

    ours = type(encoder(path))(path)
    monkeypatch.setattr(ours, "tokenizer", FirstWordOnly())
    text = "x Straßen, l'été\nc'est 2024! aren't $$$ end."
    assert np.frombuffer(ours.encode(text), "<u2").tolist() == libraries[path].encode(text, add_special_tokens=False).ids
