"""Token ids of whole texts by the ``tokenizers`` library, a chunk at a time.

A text is cut where no token can reach across, each distinct chunk is encoded once by
the library, and the ids of a text are those of its chunks in a row. That is exact:

* byte-level BPE: its pattern never matches from a visible character into the white
  space after it, so a space between two visible characters starts a new match;
* word BPE: white space is dropped, and its normalisation (composition, lower case)
  never looks across white space.

A chunk of plain characters is cut into the pieces of the library's pattern here, and each
piece goes through the library's model alone: most distinct chunks occur once or twice, and
the library's bookkeeping of a text costs more than its model. All other chunks go through
the library one by one, and texts with anything else (special strings, rare white space, runs
of spaces) whole. Caches live as long as the Python worker and are emptied at ``limit``
chunks, so memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np

#: White space beyond tab, newline, return and space, in any of the libraries' tables.
RARE_SPACE = r"\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Chunks of these characters are words, digits and marks that can be told apart here, by
#: the pattern of the word tokenizer (fixed value).
PLAIN = re.compile("[!-~ß-öø-ÿ]+")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: The same for the byte-level tokenizer, whose words may be led by a space (fixed value).
OPEN = re.compile("[\n!-~À-ÖØ-öø-ÿ]+")
LED = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \nA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\n+(?![^\n])|\n+")
#: The character by which a byte-level vocabulary writes each byte: visible ones of Latin-1 stand for
#: themselves, the others follow from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - _SHOWN))}
LIMIT = 600_000

_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a ``tokenizers`` file."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            normalised = json.load(file)["normalizer"] is not None
        _encoders[path] = (WordEncoder if normalised else ByteEncoder)(path)
    return _encoders[path]


class ChunkEncoder:
    """Cached encoder; ``encode`` gives ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str, limit: int = LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if size > 1 << 16:
            raise ValueError(f"{size} ids do not fit 16 bits")
        self.size, self.limit = size, limit
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([f"[{RARE_SPACE}]", *map(re.escape, special)]))
        self.model, self.two = self.tokenizer.model.tokenize, [i.to_bytes(2, "little") for i in range(size)]
        self.cache, self.inner = Learnt(self.learn), Learnt(self.piece)

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def piece(self, text: str) -> bytes:
        """The ids of one piece of the library's pattern."""
        if text.isascii():  # visible but for these two
            text = text.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            text = text.encode().decode("latin-1").translate(BYTE_CHARS)
        return b"".join([self.two[t.id] for t in self.model(text)])

    def joined(self, chunks: list) -> bytes:
        """The ids of ``chunks`` in a row; those not met before are learnt."""
        if len(self.cache) + len(self.inner) + len(chunks) > self.limit:
            self.cache.clear()
            self.inner.clear()
        return b"".join(map(self.cache.__getitem__, chunks))


class Learnt(dict):
    """Ids by chunk; a chunk that is not there is learnt."""

    def __init__(self, learn: Callable[[str | bytes], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, chunk: str | bytes) -> bytes:
        ids = self[chunk] = self.learn(chunk)
        return ids


class ByteEncoder(ChunkEncoder):
    """Byte-level BPE whose pattern lets one space lead a word. Keys leave that space out; those that begin with a line end have none."""

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "  " in text or " \n" in text or "\n " in text or "\t" in text or "\r" in text or self.whole.search(text):
            return self.library(text)
        if "\n" in text:  # a run of line ends starts a chunk of its own
            text = text.replace("\n", " \n")
            while "\n \n" in text:
                text = text.replace("\n \n", "\n\n")
        first, *rest = text.split(" ")
        head = self.library(first) if first else b""
        return head + self.joined(rest) if rest else head

    def learn(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self.piece(f" {chunk}")
        text = chunk if chunk.startswith("\n") else f" {chunk}"
        if not OPEN.fullmatch(chunk):
            return self.library(text)
        first, *rest = LED.findall(text)
        head = self.cache.get(first[1:]) if rest and first[0] == " " else None  # not kept on its own: most words before a mark occur once
        return (head or self.piece(first)) + b"".join(map(self.inner.__getitem__, rest))


class WordEncoder(ChunkEncoder):
    """Word BPE in lower case whose last piece of a word is marked."""

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self.library(text)
        return self.joined(text.encode().lower().split())

    def learn(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if chunk.isalpha():
            return self.piece(text)
        if not PLAIN.fullmatch(text):
            return self.library(text)
        first, *rest = WORDS.findall(text)
        head = self.cache.get(first.encode()) if rest else None  # not kept on its own: most words before a mark occur once
        return (head or self.piece(first)) + b"".join(map(self.inner.__getitem__, rest))
