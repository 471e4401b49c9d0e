"""Exact token counts at every prefix of a text, by dynamic programming.

The encoding of a prefix ends in one token, and cutting that token off leaves the
encoding of a shorter prefix. So it is enough to find, for every prefix of a word, the
one vocabulary entry that may stand last: it must be a suffix of the prefix and *fit*
behind the last token of what is left. Two tokens fit if byte-pair merging leaves the
border between them alone. With the counts stored, "how many tokens up to here" is a
look-up and "where does the text reach n tokens" a binary search; nothing is encoded
again.

Fit. While the left token is built up, its right edge is held by ever larger parts; so is
the left edge of the right token. A merge across the border happens if there are parts u
and v that make a merge of a rank before u and not after v are themselves merged on (equal
ranks go to the left place first). If no such merge exists, the border stays.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import map_batches, texts
from tidemark.llm.tokens import RARE_SPACE

#: The pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = regex.compile(r"""'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A run of white space and the visible run behind it: no token reaches over its edges.
UNIT = regex.compile(r"\s*\S+|\s+")
SPACE = regex.compile(r"\s*")
RARE = re.compile(f"[{RARE_SPACE}]")
LIMIT, SHORT = 700_000, 8
#: Lengths at which the states of all shorter prefixes are kept together, to start from.
FRONTS = (6, 4)
_counters: dict[str, PrefixCounter] = {}


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a byte-level ``tokenizers`` file."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


class PrefixCounter:
    """Counts at every byte prefix. Caches are emptied at ``limit`` entries."""

    def __init__(self, path: str, limit: int = LIMIT):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        spelt = lambda name: bytes(letters[c] for c in name)
        self.special = [t["content"] for t in data["added_tokens"]]
        names = {i: n for n, i in data["model"]["vocab"].items() if n not in self.special}
        self.ids = {spelt(n): i for i, n in names.items()}
        self.longest = max(map(len, self.ids))
        vocab = data["model"]["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: rank, left, right
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.rank[pair] = rank
            self.parts.setdefault(whole, (rank, *pair))
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.limit = limit
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.sound_memo: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.short: dict[bytes, tuple[int, int]] = {b"": (0, -1)}
        self.fronts: dict[bytes, tuple[list[int], list[int]]] = {}
        self.pieces: dict[str, list[int]] = {}
        self.units: dict[str, tuple[bytes, int]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Parts that hold the right (2) or left (1) edge in turn, with the rank that ends each."""
        known = self.edges[side - 1]
        if token not in known:
            out, at, until = [], token, float("inf")
            while True:
                out.append((at, until))
                if at not in self.parts:
                    break
                until, at = self.parts[at][0], self.parts[at][side]
            known[token] = out
        return known[token]

    def fits(self, left: int, right: int, below: float = float("inf")) -> bool:
        rank = self.rank
        for u, u_until in self.edge(left, 2):
            for v, v_until in self.edge(right, 1):
                r = rank.get((u, v))
                if r is not None and r < u_until and r <= v_until and r < below:
                    return False
        return True

    def sound(self, token: int) -> bool:
        """Whether merging a token's own bytes gives that token."""
        if token not in self.sound_memo:
            if token in self.parts:
                rank, left, right = self.parts[token]
                self.sound_memo[token] = self.sound(left) and self.sound(right) and self.fits(left, right, rank)
            else:
                self.sound_memo[token] = True
        return self.sound_memo[token]

    def step(self, text: bytes, end: int, counts, lasts) -> tuple[int, int]:
        """Count and last token of ``text[:end]``, given those of all shorter prefixes."""
        ids, memo = self.ids, self.fits_memo
        for start in range(max(0, end - self.longest), end):
            token = ids.get(text[start:end])
            if token is None or not self.sound(token):
                continue
            if not start:
                return 1, token
            pair = (lasts[start], token)
            ok = memo.get(pair)
            if ok is None:
                if len(memo) > self.limit:
                    memo.clear()
                ok = memo[pair] = self.fits(*pair)
            if ok:
                return counts[start] + 1, token
        raise ValueError("no token fits")

    def word(self, text: bytes) -> list[int]:
        """Counts at every prefix of one pre-token."""
        short, fronts, size = self.short, self.fronts, len(text)
        counts, lasts, begin = [0], [-1], 1
        for front in FRONTS:
            if front <= size and (known := fronts.get(text[:front])) is not None:
                counts, lasts, begin = known[0].copy(), known[1].copy(), front + 1
                break
        for end in range(begin, size + 1):
            state = short.get(text[:end]) if end <= SHORT else None
            if state is None:
                state = self.step(text, end, counts, lasts)
                if end <= SHORT:
                    if len(short) > self.limit:
                        short.clear()
                    short[text[:end]] = state
            counts.append(state[0])
            lasts.append(state[1])
            if end in FRONTS:
                if len(fronts) > self.limit // 4:
                    fronts.clear()
                fronts[text[:end]] = counts.copy(), lasts.copy()
        return counts[1:]

    def piece(self, text: str) -> list[int]:
        """``word`` of a pre-token, kept: units differ more than the words, digits and marks in them."""
        counts = self.pieces.get(text)
        if counts is None:
            counts = self.word(text.encode())
            if text in ("'re", "'ve", "'ll"):
                counts = [1, 2, counts[2]]
            if len(text) <= 32:
                if len(self.pieces) > self.limit:
                    self.pieces.clear()
                self.pieces[text] = counts
        return counts

    def unit(self, text: str) -> list[int]:
        """Counts at every byte prefix of a unit, each as if the text ended there.

        Two prefixes are cut otherwise than the whole: white space at the end is one run
        there, and the front of a contraction is a mark and a letter.
        """
        space = SPACE.match(text)[0]
        body, out, base, skip = text[len(space) :], [], 0, 0
        if space == " " and body:  # as most are
            body, out, skip = text, self.piece(space).copy(), 1
        elif space:
            out = self.word(space.encode())
            if not body:
                return out
            if len(space) > 1:
                base = self.word(space[:-1].encode())[-1]
            if space[-1] == " ":  # it leads the first word; its own prefix is in the run
                body, skip = " " + body, 1
            else:
                base += self.word(space[-1].encode())[-1]
        for piece in PATTERN.findall(body):
            counts = self.piece(piece)
            if skip:
                counts = counts[1:]
                skip = 0
            out += [base + c for c in counts] if base else counts
            base += counts[-1] if counts else 1
        return out

    def counts(self, text: str) -> np.ndarray:
        """Token counts at every UTF-8 byte prefix, the empty one first.

        Inside a character the count is that of its bytes so far.
        """
        if not text:
            return np.zeros(1, np.int32)
        if self.split is None or not self.split.search(text):
            return self.plain(text)
        out, base, before = [np.zeros(1, np.int32)], 0, ""
        for part in self.split.split(text):
            if part not in self.special:
                before = part
                continue
            here = self.plain(before + part[:-1])[1:]  # up to its last byte it is ordinary text
            whole = int(self.plain(before)[-1]) + 1
            out += [base + here, np.array([base + whole], np.int32)]
            base, before = base + whole, ""
        return np.concatenate([*out, base + self.plain(before)[1:]])

    def plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(1, np.int32)
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or "\t" in text or "\r" in text or RARE.search(text):
            units = UNIT.findall(text)
        else:
            first, *rest = text.split(" ")
            units = ([first] if first else []) + [" " + u for u in rest]
        known, parts, totals = self.units, [], []
        for unit in units:
            value = known.get(unit)
            if value is None:
                value = self.unit(unit)
                value = (array("i", value).tobytes(), value[-1])
                if len(unit) <= 64:
                    if len(known) > self.limit:
                        known.clear()
                    known[unit] = value
            parts.append(value[0])
            totals.append(value[1])
        local = np.frombuffer(b"".join(parts), np.int32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        total = np.array(totals, np.int32)
        return np.concatenate([np.zeros(1, np.int32), local + np.repeat(np.cumsum(total) - total, sizes).astype(np.int32)])


def tokens_in(counts: np.ndarray, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes."""
    return int(counts[n_bytes])


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """The longest byte prefix from which on every shorter one keeps to ``budget`` tokens."""
    highest = np.maximum.accumulate(counts)
    return bisect_right(highest, budget) - 1


def prefix_counts(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, counts): ``counts[i]`` tokens in the first i bytes. Null text: empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, all_texts = counter(tokenizer), texts(batch)
        found = [of.counts(t) for t in all_texts]
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(c) - 1 for c in found], pa.int64()),
            "n_tokens": pa.array([int(c[-1]) for c in found], pa.int64()), "counts": pa.array(found, pa.list_(pa.int32())),
        })

    return map_batches(documents.select("doc_id", "text"), work, "doc_id long, n_bytes long, n_tokens long, counts array<int>")


def budget_report(documents: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, cut_bytes), all read off the stored counts of each text.

    ``cut_bytes`` is where a truncation to ``limit`` tokens may cut. Null text: empty.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, rows = counter(tokenizer), []
        for text in texts(batch):
            counts = of.counts(text)
            n_bytes = len(counts) - 1
            n_tokens = tokens_in(counts, n_bytes)
            rows.append((n_bytes, n_tokens, n_tokens > limit, longest_prefix(counts, limit) if n_tokens > limit else n_bytes))
        n_bytes, n_tokens, over, cut = (list(c) for c in zip(*rows))
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
            "over_limit": pa.array(over, pa.bool_()), "cut_bytes": pa.array(cut, pa.int64()),
        })

    return map_batches(documents.select("doc_id", "text"), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_bytes long")


def op8_token_counts(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    return budget_report(documents, tokenizer, 1024)
