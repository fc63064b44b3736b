"""Encoding of a corpus with a public byte-level BPE vocabulary.

The encoding of a text is unique in its last token: for every prefix exactly
one token can end the prefix's encoding. It is the token that ends there, as
the suffix automaton over the vocabulary reports, and stands next to the last
token of the prefix before it without the two ever merging across their
border. One pass stores that token for every prefix; the ids are read off the
back pointers. The work is linear in the text, however long a word is.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"
# Fixed value: the published split pattern of the byte-level vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 60
CACHE = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Exact BPE encoding by one dynamic program over prefixes."""

    def __init__(self, path: str = VOCABULARY) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        raw = {tok: bytes(letters[c] for c in tok) for tok in vocab if all(c in letters for c in tok)}
        self.length = {vocab[t]: len(b) for t, b in raw.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = {vocab[t]: 0 for t, b in raw.items() if len(b) == 1}
        self.joint: dict[tuple[int, int], int] = {}
        for when, merge in enumerate(model["merges"], 1):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            self.joint.setdefault(pair, when)
            if token not in self.born:
                self.born[token], self.parts[token] = when, pair
        self.whole = {b: vocab[t] for t, b in raw.items() if vocab[t] in self.born}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for b, token in self.whole.items():
            self.matcher.add_word(b.decode("latin-1"), token)
        self.matcher.make_automaton()
        self.words = regex.compile(WORDS)
        self.borders: tuple[dict, dict] = ({}, {})
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}

    def border(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, when it is merged away) of each piece that stands at the token's left (0) or right (1) end while it is built."""
        found = self.borders[side].get(token)
        if found is None:
            found, piece, until = [], token, NEVER
            while True:
                found.append((piece, until))
                if piece not in self.parts:
                    break
                until, piece = self.born[piece], self.parts[piece][side]
            self.borders[side][token] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their text: no merge across the border comes first."""
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            known = True
            for x, x_until in self.border(left, 1):
                for y, y_until in self.border(right, 0):
                    when = self.joint.get((x, y))
                    # of equal merges the leftmost is made first
                    if when is not None and when < x_until and when <= y_until:
                        known = False
            if len(self.apart) > 4 * CACHE:
                self.apart.clear()
            self.apart[key] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        whole = self.whole.get(data)
        if whole is not None:
            return [whole]
        last = [-1] * (len(data) + 1)
        for end, token in self.matcher.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:
                before = end - self.length[token]
                if before == 0 or (last[before] >= 0 and self.compatible(last[before], token)):
                    last[end] = token
        out, at = [], len(data)
        while at:
            out.append(last[at])
            at -= self.length[last[at]]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.known
        for word in self.words.findall(text):
            ids = known.get(word)
            if ids is None:
                ids = self.piece(word.encode("utf-8", "replace"))
                if len(word) <= 64:
                    if len(known) >= CACHE:
                        known.clear()
                    known[word] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> PrefixEncoder:
    return PrefixEncoder(path)


def encode_column(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """(key, ids ARRAY<INT>): the ids of each whole text, without special tokens.

    Null, empty and missing texts have the empty list; blank ones have the ids
    of their blanks. Repeated rows each come out. Strings of special tokens are
    ordinary text.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            flat: list[np.ndarray] = []
            ends = [0]
            for t in batch.column(1).to_pylist():
                ids = own.encode(t) if t else []
                flat.append(np.array(ids, dtype=np.int32))
                ends.append(ends[-1] + len(ids))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["key", "ids"])

    return df.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
