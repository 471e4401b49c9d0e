"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation is done here, and it remembers where every byte came from: at each place
the longest prefix found in the model's compiled character map is replaced (a character
without an entry stays), spaces become the word mark, and every byte of the result
carries the byte offset of its source. The library segments the normalised words, and
each piece is projected back: a piece that covers normalised bytes i to j covers the
original bytes ``source[i]`` to ``source[j]``. Spans are in order and cover the text.

No piece of a vocabulary has the word mark behind another character (checked on
loading), so words are segmented each by itself and cached.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import map_batches, texts

MARK = "▁"
MARK_BYTES = MARK.encode()
LIMIT = 800_000
_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model for a file."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


class CharacterMap:
    """The compiled character map: a double-array trie of byte strings and their replacements.

    Layout (fixed by the format): u32 length of the trie, the trie's u32 units, then the
    replacements, each ended by a zero byte. A unit has its label in the low byte, a flag
    in bit 8 if a value hangs below it, its offset in bits 10 to 30 (shifted by 8 more if
    bit 9 is set); a value unit has bit 31 set and the replacement's place in the rest.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]

    @staticmethod
    def below(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that begins at ``start``."""
        units, found = self.units, None
        at = self.below(units[0])
        for i in range(start, len(text)):
            at ^= text[i]
            unit = units[at]
            if unit & 0x800000FF != text[i]:
                break
            at ^= self.below(unit)
            if unit & 0x100:
                place = units[at] & 0x7FFFFFFF
                found = i + 1 - start, self.strings[place : self.strings.index(b"\0", place)]
        return found


class PieceModel:
    def __init__(self, path: str, limit: int = LIMIT):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        spec = proto.normalizer_spec
        if not (spec.add_dummy_prefix and spec.escape_whitespaces) or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that mark the start of a word are supported")
        if any(MARK in p.piece.lstrip(MARK) for p in proto.pieces):
            raise ValueError("a piece reaches over a word's start")
        self.collapse = spec.remove_extra_whitespaces
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.end_id, self.limit = self.library.eos_id(), limit
        self.lengths = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = self.library.unk_id()
        self.has_bytes = proto.trainer_spec.byte_fallback
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end its source offset."""
        raw = text.encode()
        if not raw:
            return b"", np.zeros(1, np.int64)
        if self.map is None and not self.collapse:
            byte = np.frombuffer(raw, np.uint8)
            wide = np.where(byte == 0x20, len(MARK_BYTES), 1)
            source = np.repeat(np.arange(len(raw)), wide)
            return MARK_BYTES + raw.replace(b" ", MARK_BYTES), np.concatenate([np.zeros(len(MARK_BYTES), np.int64), source, [len(raw)]])
        out, source, at, spaced = [], [], 0, self.collapse
        while at < len(raw):
            hit = self.map.longest(raw, at) if self.map else None
            if hit is None:
                size = 1
                while at + size < len(raw) and raw[at + size] & 0xC0 == 0x80:
                    size += 1
                hit = size, raw[at : at + size]
            for byte in hit[1]:
                if byte == 0x20:
                    if not (self.collapse and spaced):
                        out.append(MARK_BYTES)
                        source += [at] * len(MARK_BYTES)
                    spaced = True
                else:
                    out.append(bytes([byte]))
                    source.append(at)
                    spaced = False
            at += hit[0]
        ends = len(raw)
        while self.collapse and out and out[-1] == MARK_BYTES:
            out.pop()
            ends = source[-1]
            del source[-len(MARK_BYTES) :]
        if not out:
            return b"", np.zeros(1, np.int64)
        # Source offsets never go back, and the first piece starts where the text does.
        return MARK_BYTES + b"".join(out), np.array([source[0]] * len(MARK_BYTES) + source + [ends], np.int64)

    def words(self, normalised: str) -> list[str]:
        """The normalised text cut before every run of word marks, each without its first mark."""
        parts = normalised.split(MARK)[1:]
        if "" not in parts:
            return parts
        out, run = [], 0
        for part in parts:
            if part:
                out.append(MARK * run + part)
                run = 0
            else:
                run += 1
        if run:
            out.append(MARK * (run - 1))
        return out

    def learn(self, words: set[str]) -> None:
        """Segment words that the cache lacks. A word has lost its first mark, as the library puts it back."""
        if "" in words:
            words.remove("")
            lone = self.library.piece_to_id(MARK)
            self.cache[""] = np.array([lone], "<u2" if self.library.vocab_size() <= 1 << 16 else "<u4").tobytes(), str(lone).encode()
        order = list(words)
        kind = "<u2" if self.library.vocab_size() <= 1 << 16 else "<u4"
        for word, ids in zip(order, self.library.encode([w.replace(MARK, " ") for w in order], num_threads=1)):
            self.cache[word] = np.array(ids, kind).tobytes(), " ".join(map(str, ids)).encode()

    def encode(self, text: str) -> tuple[np.ndarray, bytes, np.ndarray]:
        """Ids (end id behind), the same in decimal, and the bounds of their spans (one more than ids).

        Span k is bytes ``bounds[k]`` to ``bounds[k + 1]`` of the text; the end id's is empty.
        """
        normalised, source = self.normalise(text)
        if not normalised:
            return np.array([self.end_id]), str(self.end_id).encode(), np.zeros(2, np.int64)
        words = self.words(normalised.decode())
        found = list(map(self.cache.get, words))
        if None in found:
            missing = {w for w, f in zip(words, found) if f is None}
            if len(self.cache) + len(missing) > self.limit:
                self.cache, missing = {}, set(words)
            self.learn(missing)
            found = list(map(self.cache.__getitem__, words))
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<u2" if self.library.vocab_size() <= 1 << 16 else "<u4").astype(np.int64)
        decimal = b" ".join([f[1] for f in found]) + b" %d" % self.end_id
        sizes = self.lengths[ids]
        if not self.has_bytes and (ids == self.unknown).any():
            sizes = self.unknown_sizes(ids, sizes, normalised)
        bounds = source[np.concatenate([[0], np.cumsum(sizes)])]
        return np.append(ids, self.end_id), decimal, np.append(bounds, bounds[-1])

    def unknown_sizes(self, ids: np.ndarray, sizes: np.ndarray, normalised: bytes) -> np.ndarray:
        """Without byte pieces an unknown run's length is what lies up to the next known piece."""
        sizes, at, pieces = sizes.copy(), 0, [self.library.id_to_piece(i).encode() for i in ids.tolist()]
        for k, i in enumerate(ids.tolist()):
            if i == self.unknown:
                following = pieces[k + 1] if k + 1 < len(pieces) else b""
                stop = normalised.find(following, at + 1) if following else len(normalised)
                sizes[k] = stop - at
            at += int(sizes[k])
        return sizes


def encode_pieces(documents: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, bounds): ids with the end id, and piece k's span bounds[k] to bounds[k + 1] in bytes.

    Null text is empty: the end id alone.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = piece_model(model)
        made = [of.encode(t) for t in texts(batch)]
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "ids": pa.array([m[0] for m in made], pa.list_(pa.int64())),
            "bounds": pa.array([m[2] for m in made], pa.list_(pa.int64())),
        })

    return map_batches(documents.select("doc_id", "text"), work, "doc_id long, ids array<long>, bounds array<long>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids), decoded by the library."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [list(x or ()) for x in batch.column("ids").to_pylist()]
        return pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(piece_model(model).library.decode(ids, num_threads=1), pa.string())})

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string")


def piece_digest(documents: DataFrame, model: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the text decoded from them, bytes its spans cover."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, digest = piece_model(model), lambda x: hashlib.sha256(x).hexdigest()
        made = [of.encode(t) for t in texts(batch)]
        decoded = of.library.decode([m[0].tolist() for m in made], num_threads=1)
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(m[0]) for m in made], pa.int64()),
            "ids_sha256": pa.array([digest(m[1]) for m in made]),
            "decoded_sha256": pa.array([digest(t.encode()) for t in decoded]),
            "covered_bytes": pa.array([int(m[2][-1] - m[2][0]) for m in made], pa.int64()),
        })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"
    return map_batches(documents.select("doc_id", "text"), work, schema)


def op2_pieces(spark: SparkSession, documents: DataFrame, model: str) -> DataFrame:
    return piece_digest(documents, model)
