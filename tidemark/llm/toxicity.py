"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling.

A word enters the network as two inputs side by side: a word vector (of the training
vocabulary; other words share one) and a character vector, the mean over the hashed letter
trigrams of the word. Two gated recurrent layers read a window forwards and backwards,
attention pools their states, and a linear layer scores the window. A text is cut into
overlapping windows that cover all of it; its score is that of its worst window.

Training is numpy on a bounded sample: at most ``SAMPLE`` labelled documents, of each no
more than two windows, picked where the documents are. Words and trigrams enter training with
how much oftener toxic documents have them, and all weights are then learnt. The threshold is set on
whole texts of the sample and moved to 0.5. Label, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, small, stored, texts

#: Labelled documents and vocabulary at most; words of a window and from one window to the next.
SAMPLE, VOCABULARY, WINDOW, STRIDE = 12_000, 20_000, 64, 32
WORD_DIM, CHAR_DIM, CHAR_SLOTS, HIDDEN, EPOCHS, BATCH = 8, 8, 1 << 14, 8, 6, 128
#: Words scored in one go.
SLICE = 200_000
MARKS = ".,;:!?*#$%&()[]{}<>\"'|/\\-_+=~`^@"


def split_words(text: str) -> list[str]:
    return text.lower().split()


def bare(words: list[str]) -> list[str]:
    """The words without marks around them; a word of marks only is a full stop."""
    return [w.strip(MARKS) or "." for w in words]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the letter trigrams of all words in a row, and how many each word has."""
    code = np.frombuffer("".join(f" {w} \0" for w in words).encode("utf-32-le") + bytes(8), "<u4").astype(np.uint64)
    mixed = code[:-2] * np.uint64(0x9E3779B1) ^ code[1:-1] * np.uint64(0x85EBCA77) ^ code[2:] * np.uint64(0xC2B2AE3D)
    slots = ((mixed ^ mixed >> np.uint64(13)) % np.uint64(CHAR_SLOTS)).astype(np.int32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 3) - (sizes + 3)
    return slots[np.arange(len(slots)) - np.repeat(starts, sizes + 3) < np.repeat(sizes, sizes + 3)], sizes


def char_means(words: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean trigram vector of each word; the slots, and how many each word has."""
    slots, sizes = trigrams(words)
    sums = np.add.reduceat(table[slots], np.cumsum(sizes) - sizes, axis=0)
    return sums / sizes[:, None].astype(np.float32), slots, sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    words: dict[str, int]  # 0 is any other word
    weights: dict[str, np.ndarray]
    shift: float = 0.0
    moments: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, leanings: dict[str, float], char_leanings: dict[int, float] | None = None, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        some = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        words = {w: i + 1 for i, w in enumerate(sorted(leanings))}
        table = (0.05 * rng.standard_normal((len(words) + 1, WORD_DIM))).astype(np.float32)
        for word, i in words.items():
            table[i, 0] = leanings[word]
        inside, h = WORD_DIM + CHAR_DIM, HIDDEN
        weights = {"word": table, "char": (0.1 * rng.standard_normal((CHAR_SLOTS, CHAR_DIM))).astype(np.float32)}
        for slot, leaning in (char_leanings or {}).items():
            weights["char"][slot, 0] = leaning
        for d in "fb":
            weights |= {f"{d}W": some(inside, 3 * h), f"{d}b": np.zeros(3 * h, np.float32), f"{d}U": some(h, 2 * h), f"{d}V": some(h, h)}
        weights |= {"A": some(2 * h, h), "a": some(h), "o": some(2 * h), "p": np.zeros(1, np.float32)}
        return cls(words, weights)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        ids = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        means, slots, counts = char_means(words, self.weights["char"])
        return np.concatenate([self.weights["word"][ids], means], axis=1), (ids, slots, counts)

    def layer(self, d: str, gates: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States over time (time first) of one direction, from its projected inputs."""
        h, u, v = HIDDEN, self.weights[f"{d}U"], self.weights[f"{d}V"]
        state, out = np.zeros((gates.shape[1], h), np.float32), np.empty((*gates.shape[:2], h), np.float32)
        full = mask.all(axis=1)
        for t in range(len(gates)):
            zr = sigmoid(gates[t, :, : 2 * h] + state @ u)
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(gates[t, :, 2 * h :] + (r * state) @ v)
            new = state + z * (c - state)
            if keep is not None:
                keep.append((state, z, r, c))
            state = out[t] = new if full[t] else np.where(mask[t][:, None], new, state)
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        hidden = np.tanh(states @ self.weights["A"])
        score = np.where(mask, hidden @ self.weights["a"], np.float32(-1e9))
        e = np.exp(score - score.max(axis=0))
        share = e / e.sum(axis=0)
        context = np.einsum("tn,tnh->nh", share, states)
        return hidden, share, context, context @ self.weights["o"] + self.weights["p"][0]

    def logits(self, codes: np.ndarray, mask: np.ndarray, projected: dict[str, np.ndarray]) -> np.ndarray:
        """Scores of windows (time first): places in the projected words, and where there is a word."""
        ahead = self.layer("f", projected["f"][codes], mask)
        behind = self.layer("b", projected["b"][codes[::-1]], mask[::-1])[::-1]
        return self.pooled(np.concatenate([ahead, behind], axis=2), mask)[3]

    def projected(self, words: list[str]) -> dict[str, np.ndarray]:
        x = self.inputs(words)[0]
        return {d: x @ self.weights[f"{d}W"] + self.weights[f"{d}b"] for d in "fb"}

    def gradients(self, codes: np.ndarray, mask: np.ndarray, words: list[str], label: np.ndarray) -> dict[str, np.ndarray]:
        w, h = self.weights, HIDDEN
        x, (ids, slots, counts) = self.inputs(words)
        kept: dict[str, list] = {"f": [], "b": []}
        order = {"f": slice(None), "b": slice(None, None, -1)}
        out = []
        for d in "fb":
            gates = (x @ w[f"{d}W"] + w[f"{d}b"])[codes[order[d]]]
            out.append(self.layer(d, gates, mask[order[d]], kept[d])[order[d]])
        states = np.concatenate(out, axis=2)
        hidden, share, context, logit = self.pooled(states, mask)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        d_logit = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        g["o"], g["p"] = context.T @ d_logit, d_logit.sum(keepdims=True)
        d_context = d_logit[:, None] * w["o"]
        d_states = share[:, :, None] * d_context
        d_share = np.einsum("tnh,nh->tn", states, d_context)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        g["a"] = np.einsum("tna,tn->a", hidden, d_score)
        d_hidden = d_score[:, :, None] * w["a"] * (1 - hidden**2)
        g["A"] = np.einsum("tnh,tna->ha", states, d_hidden)
        d_states = d_states + d_hidden @ w["A"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            d_out = d_states[order[d], :, k * h : (k + 1) * h]
            m, later = mask[order[d]][:, :, None], np.zeros((codes.shape[1], h), np.float32)
            d_gates = np.empty((*codes.shape, 3 * h), np.float32)
            for t in range(len(codes) - 1, -1, -1):
                before, z, r, c = kept[d][t]
                total = d_out[t] + later
                here = total * m[t]
                d_c = here * z * (1 - c * c)
                d_rh = d_c @ w[f"{d}V"].T
                d_z = here * (c - before) * z * (1 - z)
                d_r = d_rh * before * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                later = total - here + here * (1 - z) + d_rh * r + d_zr @ w[f"{d}U"].T
                g[f"{d}U"] += before.T @ d_zr
                g[f"{d}V"] += (r * before).T @ d_c
                d_gates[t] = np.concatenate([d_zr, d_c], axis=1)
            flat, at = d_gates.reshape(-1, 3 * h), codes[order[d]].reshape(-1)
            by_word = np.zeros((len(words), 3 * h), np.float32)
            np.add.at(by_word, at, flat)
            g[f"{d}W"], g[f"{d}b"] = x.T @ by_word, by_word.sum(axis=0)
            d_x += by_word @ w[f"{d}W"].T
        np.add.at(g["word"], ids, d_x[:, :WORD_DIM])
        np.add.at(g["char"], slots, np.repeat(d_x[:, WORD_DIM:] / counts[:, None], counts, axis=0).astype(np.float32))
        return g

    def step(self, gradients: dict[str, np.ndarray], rate: float, turn: int) -> None:
        """One step of Adam."""
        for k, g in gradients.items():
            m, v = self.moments.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            self.weights[k] -= (rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)

    def scores(self, all_texts: list[str]) -> np.ndarray:
        """Logit of the worst window of each whole text; minus infinity without words."""
        out, at = np.full(len(all_texts), -np.inf), 0
        lists: list[list[str]] = []
        held, first = 0, 0
        for at, text in enumerate(all_texts):
            lists.append(split_words(text))
            held += len(lists[-1])
            if held >= SLICE or at + 1 == len(all_texts):
                out[first : at + 1] = self.slice_scores(lists)
                lists, held, first = [], 0, at + 1
        return out

    def slice_scores(self, lists: list[list[str]]) -> np.ndarray:
        out = np.full(len(lists), -np.inf)
        sizes = np.array([len(x) for x in lists])
        if not sizes.sum():
            return out
        codes, names = pd.factorize(np.array([w for x in lists for w in x], dtype=object))
        projected = self.projected(bare(list(names)))
        starts, doc = [], []
        for k, (size, begin) in enumerate(zip(sizes.tolist(), (np.cumsum(sizes) - sizes).tolist())):
            own = window_starts(size)
            starts += [begin + s for s in own]
            doc += [k] * len(own)
        starts, doc = np.array(starts), np.array(doc)
        ends = np.cumsum(sizes)[doc]
        for at in range(0, len(starts), 2048):
            place = np.arange(WINDOW)[:, None] + starts[None, at : at + 2048]
            mask = place < ends[None, at : at + 2048]
            logit = self.logits(codes[np.minimum(place, len(codes) - 1)], mask, projected)
            np.maximum.at(out, doc[at : at + 2048], logit)
        return out


def window_starts(size: int) -> list[int]:
    """Starts of overlapping windows that cover ``size`` words; none for none."""
    return [*range(0, max(1, size - WINDOW + STRIDE), STRIDE)] if size else []


def is_held_out(doc_id: str = "doc_id"):
    """Rows that labels are never learnt from: the checksum of the id as text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic): at most ``sample`` labelled rows outside the held-out part, half of them toxic if so many are.

    Ids with contradicting labels count as toxic.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda value: known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
    chosen = pick(1).union(pick(0))
    return documents.select("doc_id", "text").join(chosen, "doc_id")


def leaning(counted: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(key, s) of (key, clean, toxic) per task: how much oftener toxic documents have a key, small for rare keys."""
    total = counted.groupBy("key").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    n = F.col("c") + F.col("t")
    odds = F.log((F.col("t") + 0.5) / (sizes.get(1, 0) + 1)) - F.log((F.col("c") + 0.5) / (sizes.get(0, 0) + 1))
    return total.where(n >= 2).select("key", (odds * n / (n + 4) / 2).alias("s"))


def leanings(sample: DataFrame, vocabulary: int) -> tuple[dict[str, float], dict[int, float]]:
    """How much oftener toxic documents have a word, for the ``vocabulary`` words that tell most, and a trigram slot."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in small(batches):
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                for word in set(bare(split_words(text))):
                    seen.setdefault(word, [0, 0])[toxic] += 1
        yield pa.record_batch({
            "key": pa.array(list(seen), pa.string()), "clean": pa.array([c for c, _ in seen.values()], pa.int64()),
            "toxic": pa.array([t for _, t in seen.values()], pa.int64()),
        })

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, CHAR_SLOTS), np.int64)
        for batch in small(batches):
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                own = bare(split_words(text))
                if own:
                    seen[toxic, np.unique(trigrams(own)[0])] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.record_batch({"key": pa.array(at, pa.int64()), "clean": pa.array(seen[0, at], pa.int64()), "toxic": pa.array(seen[1, at], pa.int64())})

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = sample.select("text", "toxic")
    top = leaning(rows.mapInArrow(words, "key string, clean long, toxic long"), sizes).orderBy(F.desc(F.abs("s")), "key").limit(vocabulary)
    chars = leaning(rows.mapInArrow(slots, "key long, clean long, toxic long"), sizes)
    return tuple({r["key"]: max(-1.0, min(2.0, r["s"])) for r in found.collect()} for found in (top, chars))


def training_windows(sample: DataFrame, of_words: dict[str, float], of_slots: dict[int, float]) -> list[tuple[list[str], int]]:
    """The telling window of each document, and of a clean one another at random: two windows each at most."""

    slot_weight = np.zeros(CHAR_SLOTS)
    slot_weight[list(of_slots)] = list(of_slots.values())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows: list[tuple[str, int]] = []
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                words = bare(split_words(text))
                starts = window_starts(len(words))
                if not starts:
                    continue
                slots, sizes = trigrams(words)
                odd = np.add.reduceat(slot_weight[slots], np.cumsum(sizes) - sizes) / sizes
                lean = np.cumsum([0.0, *(max(0.0, of_words.get(w, 0.0), c) ** 2 for w, c in zip(words, odd.tolist()))])
                sums = [lean[min(s + WINDOW, len(words))] - lean[s] for s in starts]
                chosen = {int(np.argmax(sums))} | (set() if toxic else {len(words) * 7919 % len(starts)})
                rows += [(" ".join(words[starts[k] : starts[k] + WINDOW]), toxic) for k in sorted(chosen)]
            if rows:
                yield pa.record_batch({"window": pa.array([r[0] for r in rows]), "toxic": pa.array([r[1] for r in rows], pa.int64())})

    rows = sample.select("text", "toxic").mapInArrow(cut, "window string, toxic long").collect()
    return sorted((r["window"].split(" "), r["toxic"]) for r in rows)


def train(
    windows: list[tuple[list[str], int]], of_words: dict[str, float], of_slots: dict[int, float] | None = None, epochs: int = EPOCHS, seed: int = 5
) -> Network:
    net, rng, turn = Network.fresh(of_words, of_slots, seed), np.random.default_rng(seed), 0
    if not windows:
        return net
    toxic = np.array([t for _, t in windows], np.float32)
    steps = max(epochs, -(-150 * BATCH // len(windows)))  # a small sample is gone through oftener
    for epoch in range(steps):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            codes, names = pd.factorize(np.array([w for i in part for w in windows[i][0]], dtype=object))
            sizes = np.array([len(windows[i][0]) for i in part])
            place = np.arange(int(sizes.max()))[:, None] + (np.cumsum(sizes) - sizes)[None, :]
            mask = np.arange(len(place))[:, None] < sizes[None, :]
            turn += 1
            gradients = net.gradients(codes[np.minimum(place, len(codes) - 1)], mask, list(names), toxic[part])
            net.step(gradients, 0.02 if epoch < steps * 2 / 3 else 0.005, turn)
    net.moments = {}
    return net


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Network:
    """Train on ``labels`` (doc_id, toxic) and set the threshold; without labels every text is clean."""
    ship_package(documents.sparkSession)
    rows = stored(training_sample(documents, labels, sample), "toxic-sample")
    of_words, of_slots = leanings(rows, vocabulary)
    windows = training_windows(rows, of_words, of_slots)
    net = train(windows, of_words, of_slots)
    if len({t for _, t in windows}) < 2:
        net.shift = np.inf
        return net

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                yield pa.record_batch({"logit": pa.array(net.scores(texts(batch)), pa.float64()), "toxic": batch.column("toxic").cast(pa.int64())})

    seen = [(r["logit"], r["toxic"]) for r in rows.mapInArrow(score, "logit double, toxic long").collect()]
    net.shift = threshold(np.array([x for x, _ in seen]), np.array([t for _, t in seen]))
    return net


def threshold(logit: np.ndarray, toxic: np.ndarray) -> float:
    """The cut that makes the fewest errors on either class (in shares); the middle of equally good ones."""
    cuts = np.unique(logit[np.isfinite(logit)])
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    bad = np.sort(logit[toxic == 1])
    good = np.sort(logit[toxic == 0])
    error = np.searchsorted(bad, cuts) / len(bad) + 2 * (1 - np.searchsorted(good, cuts) / len(good))
    best = np.flatnonzero(error == error.min())
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def score_documents(documents: DataFrame, net: Network) -> DataFrame:
    """``documents`` with score (0 to 1) and predicted (1 from 0.5). A text without words scores 0.

    Other columns stay; those named score or predicted are replaced.
    """
    ship_package(documents.sparkSession)
    columns = [c for c in documents.columns if c not in ("score", "predicted")]
    fields = {f.name: f.dataType.simpleString() for f in documents.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                with np.errstate(over="ignore", invalid="ignore"):
                    logit = net.scores(texts(batch))
                    score = np.where(np.isfinite(logit), 1 / (1 + np.exp(-np.clip(logit - net.shift, -500, 500))), 0.0)
                yield pa.record_batch(
                    [*(batch.column(c) for c in columns), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*columns, "score", "predicted"]
                )

    schema = ", ".join(f"`{c}` {fields[c]}" for c in columns)
    return documents.select(*columns).mapInArrow(run, f"{schema}, score double, predicted int")


def keep_clean(documents: DataFrame, net: Network) -> DataFrame:
    """The rows whose whole text scores below 0.5, all columns as they are."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                logit = net.scores(texts(batch))
                yield batch.filter(pa.array(~(np.isfinite(logit) & (logit >= net.shift))))

    return documents.mapInArrow(run, documents.schema)


def op6_toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    net = fit(documents, labels)
    return score_documents(documents.select("doc_id", "text"), net).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
