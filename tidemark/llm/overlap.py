"""Same or near-same records across splits.

Winnowing fingerprints: the rolling-hash minima of each text are joined across
the splits, the rarest first and as many as a near text must share one of. Two
texts that have enough of them in common are aligned word by word from chains
of seeds, and a pair counts if enough of both texts is covered.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, discard

GRAM, WINDOW, SEED = 40, 20, 6
#: cells of the table of frequencies, its pieces, and how many partial tables one task adds up
CELLS, PIECES, FAN_IN = 1 << 21, 32, 32


class Scale(NamedTuple):
    """How texts of `least` to `most` letters are fingerprinted, and the share of them two near texts must have in common."""

    gram: int
    window: int
    share: float
    least: int
    most: float


#: neighbouring scales overlap by half, so two texts whose lengths allow the similarity always have one in common
SCALES = (Scale(GRAM, WINDOW, 0.15, 500, math.inf), Scale(20, 6, 0.2, 100, 750), Scale(8, 2, 0.15, 1, 150))
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def canonical(text: str) -> str:
    """The text as it is fingerprinted: lower case, letters and digits only."""
    return "".join(words_of(text))


@lru_cache(maxsize=2)
def _powers_to(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_to(base, max(4096, 1 << (n - 1).bit_length()))[:n]


def _winnowed(text: str, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of a canonical text that isn't empty."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    n = len(codes)
    gram = min(gram, n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * _powers(BASE, n), out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * _powers(UNBASE, n)[: n - gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    window = min(window, len(h))
    low, span = h, 1
    while span < window:
        step = min(span, window - span)
        low, span = np.minimum(low[:-step], low[step:]), span + step
    # only where the minimum changes, or comes again at the right end, is another place picked
    new = low == h[window - 1 :]
    new[0] = True
    new[1:] |= low[1:] != low[:-1]
    at = np.flatnonzero(new)
    rows = h[at[:, None] + np.arange(window - 1, -1, -1)]
    picked = at + window - 1 - np.argmin(rows, axis=1)
    return picked, h[picked]


def fingerprints(text: str, gram: int = GRAM, window: int = WINDOW) -> list[tuple[int, int]]:
    """(position, hash) of the winnowed grams of a canonical text: the rightmost least hash of each window.

    Any stretch of gram + window - 1 letters that two texts share gives both a
    common fingerprint. A text shorter than a gram has one fingerprint of
    itself, an empty one has none.
    """
    if not text:
        return []
    places, hashes = _winnowed(text, gram, window)
    return list(zip(places.tolist(), hashes.astype(np.int64).tolist(), strict=True))


def chain(seeds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of seeds that goes up in both texts."""
    seeds = sorted(set(seeds), key=lambda s: (s[0], -s[1]))
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(seeds)
    for i, (_, b) in enumerate(seeds):
        k = bisect.bisect_left(tails, b)
        back[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(b)
            ends.append(i)
        else:
            tails[k], ends[k] = b, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(seeds[i])
        i = back[i]
    return out[::-1]


def _rows(a: Sequence, b: Sequence) -> Iterator[int]:
    """For each prefix of b the bits of a; a bit is 0 where a's prefix up to it has one more word in common than the one before."""
    places: dict = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & places.get(w, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def common_length(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence."""
    v = (1 << len(a)) - 1
    for v in _rows(a, b):  # noqa: B007
        pass
    return len(a) - v.bit_count()


def _heads(a: Sequence, b: Sequence) -> np.ndarray:
    """What each prefix of a, the empty one first, has in common with b."""
    v = (1 << len(a)) - 1
    for v in _rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_places(a: Sequence, b: Sequence, bits: int = 1 << 28) -> list[tuple[int, int]]:
    """(place in a, place in b) of a longest common subsequence; halves b while the table has more than `bits`."""
    if len(b) > 1 and len(a) * len(b) > bits:
        half = len(b) // 2
        cut = int(np.argmax(_heads(a, b[:half]) + _heads(a[::-1], b[half:][::-1])[::-1]))
        return common_places(a[:cut], b[:half], bits) + [(i + cut, j + half) for i, j in common_places(a[cut:], b[half:], bits)]
    rows, out, i, j = list(_rows(a, b)), [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def seeds_of(a: Sequence, b: Sequence, size: int = SEED) -> list[tuple[int, int]]:
    """Places of the runs of `size` words in both; the k-th time a run stands in one goes with the k-th in the other."""
    at: dict = {}
    for j in range(len(b) - size + 1):
        at.setdefault(tuple(b[j : j + size]), []).append(j)
    seen: dict = {}
    out = []
    for i in range(len(a) - size + 1):
        g = tuple(a[i : i + size])
        k = seen[g] = seen.get(g, -1) + 1
        if k < len(at.get(g, ())):
            out.append((i, at[g][k]))
    return out


def moved_words(a: Sequence, b: Sequence) -> int:
    """Words matched by chains of seeds and by alignment of all that lies between and around a chain's seeds.

    When a chain is done, the seeds it left over are chained anew, so passages
    that changed places count too; no word counts twice. Then the gaps are
    aligned, chain by chain: those of the first whole, those around a moved
    passage up to the next matched word.
    """
    used_a, used_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    left, chains, matched = seeds_of(a, b), [], 0
    while left:
        runs: list[tuple[int, int, int]] = []
        for i, j in chain(left):
            if runs and (i < runs[-1][0] + runs[-1][2] or j < runs[-1][1] + runs[-1][2]):
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                used_a[i + n] = used_b[j + n] = True
                n += 1
            if n:
                runs.append((i, j, n))
                matched += n
        if not runs:
            break
        chains.append(runs)
        # what is left of a run partly used is no seed of its own
        left = [(i, j) for i, j in left if not used_a[i : i + SEED].any() and not used_b[j : j + SEED].any()]
    for c, runs in enumerate(chains):
        lo_a = lo_b = 0
        hi_a, hi_b = len(a), len(b)
        if c:
            lo_a, lo_b = runs[0][0], runs[0][1]
            hi_a, hi_b = runs[-1][0] + runs[-1][2], runs[-1][1] + runs[-1][2]
            while lo_a and not used_a[lo_a - 1]:
                lo_a -= 1
            while lo_b and not used_b[lo_b - 1]:
                lo_b -= 1
            while hi_a < len(a) and not used_a[hi_a]:
                hi_a += 1
            while hi_b < len(b) and not used_b[hi_b]:
                hi_b += 1
        for i, j, n in [*runs, (hi_a, hi_b, 0)]:
            free_a, free_b = [x for x in range(lo_a, i) if not used_a[x]], [y for y in range(lo_b, j) if not used_b[y]]
            if free_a and free_b:
                for x, y in common_places([a[x] for x in free_a], [b[y] for y in free_b]):
                    used_a[free_a[x]] = used_b[free_b[y]] = True
                    matched += 1
            lo_a, lo_b = i + n, j + n
    return matched


def aligned_words(a: Sequence, b: Sequence) -> int:
    """Words that two texts share in order, or with moved passages where that is more."""
    return max(common_length(a, b), moved_words(a, b))


def _tokens(text: str, scale: Scale) -> np.ndarray:
    """The fingerprints of a canonical text as a set, sorted: the k-th time one stands in a text is a token of its own."""
    h = np.sort(_winnowed(text, scale.gram, scale.window)[1])
    place = np.arange(len(h))
    first = np.concatenate([[True], h[1:] != h[:-1]])
    nth = place - np.maximum.accumulate(np.where(first, place, 0))
    with np.errstate(over="ignore"):
        h = h + nth.astype(np.uint64) * np.uint64(BASE) + np.uint64(scale.gram) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.sort(h)


def scales_of(text: str) -> list[int]:
    return [k for k, s in enumerate(SCALES) if s.least <= len(text) <= s.most]


def needed(scale: Scale, size: int) -> tuple[int, int]:
    """Fingerprints a near text must share, and how many of these the join looks for."""
    least = max(1, math.ceil(scale.share * size - 1e-9))
    return least, -(-least // 3)


def shares_fingerprints(a: str, b: str) -> bool:
    """Whether two canonical texts have the wanted share of the longer list of fingerprints in common, on a scale of both."""
    for k in set(scales_of(a)) & set(scales_of(b)):
        x, y = _tokens(a, SCALES[k]), _tokens(b, SCALES[k])
        if len(np.intersect1d(x, y, assume_unique=True)) >= needed(SCALES[k], max(len(x), len(y)))[0]:
            return True
    return False


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens.astype(np.uint64) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def frequencies(prints: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each cell of the fingerprints' hashes: a byte that grows with its frequency, and whether both splits are in it.

    The table has CELLS cells whatever the size of the data; it is counted in
    pieces, and pieces are added up FAN_IN at a time.
    """
    width = CELLS // PIECES
    schema = "piece int, part int, counts binary"

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, CELLS), np.int32)
        for f in frames:
            for side, flag in enumerate(("in_train", "in_other")):
                mine = [t for t, x in zip(f["tokens"], f[flag], strict=True) if x]
                if mine:
                    cells, n = np.unique(_cells(np.concatenate(mine).view(np.uint64)), return_counts=True)
                    seen[side, cells] += n.astype(np.int32)
        part = TaskContext.get().partitionId()
        for k in range(PIECES):
            piece = seen[:, k * width : (k + 1) * width]
            if piece.any():
                yield pd.DataFrame({"piece": [k], "part": [part], "counts": [zlib.compress(piece.astype(np.int64).tobytes(), 1)]})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in f["counts"])
        return pd.DataFrame({"piece": [f["piece"].iloc[0]], "part": [f["part"].iloc[0] // FAN_IN], "counts": [zlib.compress(total.tobytes(), 1)]})

    tables = prints.mapInPandas(count, schema)
    parts = max(2, prints.rdd.getNumPartitions())
    while parts > 1:
        tables = tables.groupBy("piece", F.expr(f"part div {FAN_IN}")).applyInPandas(add, schema)
        parts = -(-parts // FAN_IN)
    counts = np.zeros((2, CELLS), np.int64)
    for r in tables.collect():  # PIECES rows
        counts[:, r["piece"] * width : (r["piece"] + 1) * width] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64).reshape(2, width)
    rank = np.minimum(255, np.floor(4 * np.log2(1.0 + counts.sum(axis=0)))).astype(np.uint8)
    return rank, (counts > 0).all(axis=0)


def cross_split_overlaps(records: DataFrame, least_similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs of different texts, one in the training split and one outside it, that are light edits of each other.

    records: (id LONG, train BOOLEAN, text STRING). A pair must have a share
    of the longer one's fingerprints in common (SCALES) and be alike: twice
    the words aligned over the words of both is at least `least_similarity`.
    Aligned are the longest common subsequence of words or, where that is more,
    passages that changed places (those with a run of SEED words in common, and
    what is alike around it). Every pair for which both hold is found.

    All texts' fingerprints have one order, rare cells of a table of
    frequencies first. Of a text with n of them, t of which a near text must
    share, only the first n - t + k are joined: any near text has at least k of
    these among its own, so a pair with fewer is no candidate, and what is in
    every text (layouts) isn't joined. Texts of which less than t stand in the
    other split at all aren't joined either.

    Result: (class_train, class_other, similarity, coverage_train,
    coverage_other) between classes of exactly the same canonical text, and
    (id, train, class) for all records: a frame each. A class is named by its
    least id. Null texts and texts without a letter or digit are in no class.
    Very long texts are processed whole. No rows give no rows.
    """

    @F.pandas_udf("binary")
    def digest(s: pd.Series) -> pd.Series:
        found = (canonical(t) if t else "" for t in s)
        return pd.Series([hashlib.blake2b(c.encode("utf-8", "surrogatepass"), digest_size=16).digest() if c else None for c in found], index=s.index, dtype=object)

    records = records.select("id", "train", "text")
    known = cut_lineage(records.where("text is not null and train is not null").select("id", "train", digest("text").alias("digest")).where("digest is not null"), "records")
    reps = known.groupBy("digest").agg(F.min("id").alias("class"), F.max("train").alias("in_train"), F.max(~F.col("train")).alias("in_other"))
    members = cut_lineage(known.join(reps.select("digest", "class"), "digest").select("id", "train", "class"), "members")
    reps = cut_lineage(reps.drop("digest"), "classes")
    discard(known)

    def fingerprint(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for c, tr, ot, text in zip(f["class"], f["in_train"], f["in_other"], f["text"], strict=True):
                own = canonical(text)
                rows += [(c, tr, ot, k, _tokens(own, SCALES[k]).view(np.int64)) for k in scales_of(own)]
            yield pd.DataFrame(rows, columns=["class", "in_train", "in_other", "scale", "tokens"])

    texts = records.select(F.col("id").alias("class"), "text").join(reps, "class")
    prints = cut_lineage(texts.mapInPandas(fingerprint, "class long, in_train boolean, in_other boolean, scale int, tokens array<long>"), "prints")
    table = prints.sparkSession.sparkContext.broadcast(frequencies(prints))  # two bytes a cell

    def select(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank, both = table.value
        for f in frames:
            rows = []
            for c, tr, ot, k, tokens in zip(f["class"], f["in_train"], f["in_other"], f["scale"], f["tokens"], strict=True):
                own = tokens.view(np.uint64)
                cells = _cells(own)
                met = both[cells]
                least, wanted = needed(SCALES[k], len(own))
                if met.sum() < least:
                    continue
                first = np.lexsort((own, rank[cells]))[: len(own) - least + wanted]
                rows.append((c, tr, ot, k, wanted, tokens[first[met[first]]]))
            yield pd.DataFrame(rows, columns=["class", "in_train", "in_other", "scale", "wanted", "tokens"])

    joined = prints.mapInPandas(select, "class long, in_train boolean, in_other boolean, scale int, wanted int, tokens array<long>")
    postings = joined.select("class", "in_train", "in_other", "scale", "wanted", F.explode("tokens").alias("token"))
    left = postings.where("in_train").select("token", "scale", F.col("class").alias("class_train"), F.col("wanted").alias("wanted_train"))
    right = postings.where("in_other").select("token", F.col("class").alias("class_other"), F.col("wanted").alias("wanted_other"))
    pairs = left.join(right, "token").where("class_train <> class_other").groupBy("class_train", "class_other", "scale")
    pairs = pairs.agg(F.count("*").alias("shared"), F.max(F.greatest("wanted_train", "wanted_other")).alias("wanted")).where("shared >= wanted").select("class_train", "class_other").distinct()
    pairs = cut_lineage(pairs, "pairs")
    discard(prints)

    asked = pairs.select(F.col("class_train").alias("class")).union(pairs.select("class_other")).distinct()
    texts = records.select(F.col("id").alias("class"), "text").join(asked, "class")
    both = pairs.join(texts.select(F.col("class").alias("class_train"), F.col("text").alias("text_train")), "class_train").join(texts.select(F.col("class").alias("class_other"), F.col("text").alias("text_other")), "class_other")

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for c, d, s, t in zip(f["class_train"], f["class_other"], f["text_train"], f["text_other"], strict=True):
                one, two = words_of(s), words_of(t)
                # no alignment matches more than the shorter text
                if 2 * min(len(one), len(two)) < least_similarity * (len(one) + len(two)) or not shares_fingerprints("".join(one), "".join(two)):
                    continue
                m = aligned_words(one, two)
                similarity = 2 * m / (len(one) + len(two))
                if similarity >= least_similarity:
                    rows.append((c, d, similarity, m / len(one), m / len(two)))
            yield pd.DataFrame(rows, columns=["class_train", "class_other", "similarity", "coverage_train", "coverage_other"])

    links = both.select("class_train", "class_other", "text_train", "text_other").mapInPandas(align, "class_train long, class_other long, similarity double, coverage_train double, coverage_other double")
    return cut_lineage(links, "links"), members


def overlap_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id_train, id_other, similarity, coverage_train, coverage_other): every pair of records, exact copies included."""
    train = members.where("train").select(F.col("id").alias("id_train"), F.col("class").alias("class_train"))
    other = members.where("not train").select(F.col("id").alias("id_other"), F.col("class").alias("class_other"))
    measures = ["similarity", "coverage_train", "coverage_other"]
    same = train.join(other, F.col("class_train") == F.col("class_other")).select("id_train", "id_other", *[F.lit(1.0).alias(m) for m in measures])
    near = links.join(train, "class_train").join(other, "class_other").select("id_train", "id_other", *measures)
    return same.unionByName(near)
