"""Benchmark decontamination (operator 6) by spaced seeds.

A seed is a fixed mask over at most SPAN consecutive words that ignores some places; its hash survives substitutions
there. Every benchmark item and every document is hashed under all MASKS at each word, hashes are joined, and each hit
puts an item beside a document at one shift. MASKS leave a seed in every overlap, wherever its substitutions stand: a
test enumerates all placements. Shifts with too few equal words are dropped at once, and in the others the words are
compared one by one: an overlap is a stretch of
at least MIN_WORDS words (or the whole item if it is shorter) of which at least SHARE agree.

Items of fewer than SPAN words are matched as a whole, word by word; items without words match nothing. Seeds of the
benchmark are handled in blocks of at most BLOCK_SEEDS (a bounded broadcast each), and documents are read once for
each block; so the benchmark may be of any size. Null and empty texts overlap with nothing. Null ids of documents or
items are left out. An overlap is reported once for each document, item and shift at which it is longest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, prepare, saved, slices, word_hashes

SPAN = 12
# Words that each seed looks at. Every 12 words with 2 substitutions, 15 with 3, 20 with 4 and 25 with 5 hold one of the
# masks whole, and so does every longer overlap: at SHARE, one of its parts of 13 to 25 words has that share itself.
MASKS = ["11110111", "1100101111", "11011001011", "1111111", "110100101011", "11100010111", "111010100011"]
MIN_WORDS = 13
SHARE = 0.8
BLOCK_SEEDS = 1 << 21


def seeds(words: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each mask: hashes of all its spans that lie in one row, and their starts."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = []
    for k, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n <= 0:
            out.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
            continue
        h = np.full(n, k + 1, np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                h += words[j:j + n] * U64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
        starts = np.flatnonzero(row[:n] == row[len(mask) - 1:])
        out.append((mix(h[starts]), starts))
    return out


def overlap(agree: np.ndarray, least: int, share: float = SHARE) -> tuple[int, int] | None:
    """The longest stretch [a, b) that begins and ends with an agreement, holds ``least`` places and ``share`` of them agree."""
    hits = np.flatnonzero(agree)
    if not len(hits):
        return None
    total = np.concatenate([[0], np.cumsum(agree)])
    best = None
    for a in hits.tolist():
        ends = hits[hits >= a + least - 1]
        ok = ends[total[ends + 1] - total[a] >= share * (ends + 1 - a) - 1e-9]
        if len(ok) and (best is None or ok[-1] + 1 - a > best[1] - best[0]):
            best = (a, int(ok[-1]) + 1)
    return best


class Seeds:
    """Seeds of a block of items: sorted hashes with item and place, and the items' words."""

    def __init__(self, ids: list[int], words: np.ndarray, first: np.ndarray):
        self.ids, self.words, self.first = ids, words, first
        count = np.diff(first)
        h, starts = (np.concatenate(x) for x in zip(*seeds(words, first), strict=True))
        row = np.searchsorted(first, starts, "right") - 1
        order = np.flatnonzero(count[row] >= SPAN)
        order = order[np.argsort(h[order], kind="stable")]
        self.hash, self.item = h[order], row[order]
        self.place = starts[order] - first[self.item]
        # shorter items: by their first word, then as a whole
        self.short = {i: words[first[i]:first[i + 1]] for i in np.flatnonzero((count > 0) & (count < SPAN))}
        self.heads = np.sort(np.array([w[0] for w in self.short.values()], np.uint64))

    def hits(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shift) of documents that may overlap: shift is the document word that meets the item's first."""
        found = []
        if len(self.hash):
            for h, starts in seeds(words, first):
                lo = np.searchsorted(self.hash, h)
                at = np.flatnonzero(self.hash[np.minimum(lo, len(self.hash) - 1)] == h)
                n = np.searchsorted(self.hash, h[at], "right") - lo[at]
                which = np.repeat(lo[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                found.append(np.stack([self.item[which], np.repeat(starts[at], n) - self.place[which]], axis=1))
        if len(self.heads):
            at = np.flatnonzero(np.isin(words, self.heads))
            for i, own in self.short.items():
                p = at[words[at] == own[0]]
                p = p[p + len(own) <= len(words)]
                for j in range(1, len(own)):
                    p = p[words[p + j] == own[j]]
                row = np.searchsorted(first, p, "right") - 1
                p = p[p + len(own) <= first[row + 1]]
                found.append(np.stack([np.full(len(p), i), p], axis=1))
        if not found:
            return []
        pairs = np.concatenate(found)
        if not len(pairs):
            return []
        # a shift can begin before its row: the row is that of the seed's words, so find it by the item's middle later
        pairs = np.unique(pairs, axis=0)
        return [tuple(x) for part in np.array_split(pairs, -(-len(pairs) // 10000)) for x in part[self.enough(part, words)].tolist()]

    def enough(self, pairs: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether an item agrees at a shift with as many words as the shortest overlap has (rows apart from each other or not)."""
        item, shift = pairs.T
        size = np.diff(self.first)[item]
        low, high = np.maximum(0, -shift), np.minimum(size, len(words) - shift)
        n = np.maximum(0, high - low)
        which = np.repeat(np.arange(len(pairs)), n)
        j = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        equal = self.words[self.first[item][which] + j] == words[shift[which] + j]
        return np.bincount(which, equal, len(pairs)) >= SHARE * np.minimum(MIN_WORDS, size) - 1e-9


def _overlaps(block: Seeds, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(row, item, first word in the row, words, share) of the longest overlap of each row and item."""
    best: dict[tuple[int, int], tuple[int, int, float]] = {}
    for item, shift in block.hits(words, first):
        own = block.words[block.first[item]:block.first[item + 1]]
        a, b = max(0, shift), min(len(words), shift + len(own))
        # an item laid over several rows is compared with each of them by itself
        r = int(np.searchsorted(first, a, "right")) - 1
        while r < len(first) - 1 and first[r] < b:
            lo, hi = max(a, int(first[r])), min(b, int(first[r + 1]))
            if hi > lo:
                agree = words[lo:hi] == own[lo - shift:hi - shift]
                found = overlap(agree, min(MIN_WORDS, len(own)))
                if found:
                    x, y = found
                    score = float(agree[x:y].mean())
                    old = best.get((r, item))
                    if old is None or (y - x, score, -(lo + x)) > (old[1], old[2], -(old[0] + int(first[r]))):
                        best[r, item] = (lo + x - int(first[r]), y - x, score)
            r += 1
    return [(r, i, *v) for (r, i), v in best.items()]


def contaminated(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text_col: str,
                 block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(id, item_id, start_word, n_words, share): the longest overlap of each document with each item."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    bench = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item is not null and text is not null")
    # blocks of items by a hash, so that each holds at most about half of block_seeds seeds (a word is at least two bytes)
    size = bench.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size * len(MASKS) // block_seeds))
    out = None
    for k in range(blocks):
        own = bench.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item", "text").toArrow()
        words, first = word_hashes(own.column("text").combine_chunks() if own.num_rows else pa.array([], pa.string()))
        shared = spark.sparkContext.broadcast(Seeds(own.column("item").to_pylist(), words, first))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in slices(batches, "text"):
                words, first = word_hashes(b.column("text"))
                ids = np.asarray(b.column("id"))
                found = _overlaps(block, words, first)
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(ids[x[0]]) for x in found], pa.int64()), pa.array([block.ids[x[1]] for x in found], pa.int64()),
                    pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int32()), pa.array([x[4] for x in found], pa.float64())],
                    ["id", "item_id", "start_word", "n_words", "share"])

        part = rows.mapInArrow(run, "id long, item_id long, start_word int, n_words int, share double")
        out = part if out is None else out.unionByName(part)
    # repeated rows of a document, or repeated items, report an overlap once
    return saved(out, "overlaps").groupBy("id", "item_id").agg(F.max(F.struct("n_words", "share", (-F.col("start_word")).alias("s"))).alias("x")).select(
        "id", "item_id", (-F.col("x.s")).alias("start_word"), F.col("x.n_words").alias("n_words"), F.col("x.share").alias("share"))
