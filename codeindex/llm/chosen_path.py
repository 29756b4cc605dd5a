"""Jaccard similarity join on word shingles (operator 7) by chosen paths.

Texts are sets of shingles (five lower-cased words; a shorter text is one shingle of all its words). Texts with equal
sets form a class; classes of Jaccard similarity >= ``threshold`` are linked.

* Each set becomes a sketch of SKETCH one-permutation min-hashes: two sets agree in a share of places that estimates
  their similarity.
* In each of RUNS runs all sets start in one bucket, and buckets are split recursively: the path to a bucket chooses
  a place of the sketch, and the sets part by the token they hold there. Sets stay together exactly while they share
  the sampled tokens. A bucket that is small enough is searched by brute force; a larger one is split on. Sets still
  together after MAX_DEPTH splits are joined as one candidate group.
* Brute force in a bucket compares sketches (at SKETCH_SHARE or more) and yields candidate groups over all runs; all
  pairs of a candidate group are then verified on the true sets, in blocks of BLOCK members, so that a group of any
  size is dealt out over tasks and only counts and a spanning forest of its links leave them.

A pair at the threshold survives d splits of a run with probability threshold**d; small buckets stop at d = 2, so
RUNS = 10 runs leave about (1 - 0.64)**10 < 1e-4 of such pairs apart, and fewer of the more similar ones. Sets that any
of these runs had in a larger bucket get further runs among themselves, as many as the deepest split reached needs to
leave at most MISSED of the pairs at the threshold apart.

Null or empty texts (no words) have no links and are classes of their own. Null ids are left out. Rows
that repeat an id are one document, so they are expected to repeat its text as well; if they don't, one of them counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, by_groups, mix, prepare, saved, seeded, shingle_hashes, signed, slices, word_hashes
from .components import components

WIDTH = 5
THRESHOLD = 0.8
SKETCH = 128
RUNS = 10
MISSED = 1e-4
MIN_DEPTH = 2
MAX_DEPTH = 7
SMALL = 64
SKETCH_SHARE = 0.6
BLOCK = 128


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and their n+1 offsets."""
    words, first = word_hashes(texts)
    h, first = shingle_hashes(words, first, width)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.empty(0, bool)
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(first)))


def sketches(h: np.ndarray, first: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """One 16-bit token per place: the least hash of the set's members that fall in the place.

    Empty places borrow from places drawn by a hash that is the same for all sets, so that two sets agree in a
    borrowed place as often as in their own.
    """
    n = len(first) - 1
    shift = U64(64 - size.bit_length() + 1)
    row = np.repeat(np.arange(n), np.diff(first))
    place = row * size + (h >> shift).astype(np.int64)  # ascending, as h ascends in each row
    lead = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(h) else np.empty(0, np.int64)
    out = np.zeros(n * size, np.uint64)
    have = np.zeros(n * size, bool)
    out[place[lead]] = mix(h[lead])
    have[place[lead]] = True
    own = have.copy()
    some = np.repeat(np.diff(first) > 0, size)
    source, own_values = np.arange(n * size), out.copy()
    for attempt in range(1, 4 * size + 1):
        empty = np.flatnonzero(~have & some)
        if not len(empty):
            break
        base, at = empty // size * size, empty % size
        probe = base + ((seeded(at.astype(np.uint64), attempt) % U64(size)).astype(np.int64) if attempt <= 3 * size else (at + attempt) % size)
        ok = own[probe]
        source[empty[ok]] = probe[ok]
        have[empty[ok]] = True
    out = own_values[source]
    return (out & U64(0xFFFF)).astype(np.uint16).reshape(n, size)


def set_hashes(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each set, whatever the order of its members."""
    out = []
    for seed in (11, 13):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(seeded(h, seed), dtype=np.uint64)])
        out.append(signed(mix(total[first[1:]] - total[first[:-1]])))
    return out


def features(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(id, h1, h2, n, sketch): a 128-bit hash of the set, its size, its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = shingle_sets(b.column("text"), width)
            h = seeded(h, 7)
            row = np.repeat(np.arange(b.num_rows), np.diff(first))
            h = h[np.lexsort((h, row))]
            both = set_hashes(h, first)
            sketch = sketches(h, first)
            off = np.arange(b.num_rows + 1, dtype=np.int32) * (sketch.shape[1] * 2)
            packed = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(off), pa.py_buffer(sketch.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(both[0]), pa.array(both[1]), pa.array(np.diff(first), pa.int64()), packed],
                                             ["id", "h1", "h2", "n", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    return rows.mapInArrow(run, "id long, h1 long, h2 long, n long, sketch binary")


def paths(sketch: np.ndarray, run: int, depth: int = MAX_DEPTH) -> np.ndarray:
    """The bucket of every set after 1, 2, ... splits of a run (rows x depth)."""
    n, size = sketch.shape
    key = seeded(np.zeros(n, np.uint64), run + 101)
    out = np.empty((n, depth), np.uint64)
    for d in range(depth):
        place = (key % U64(size)).astype(np.int64)
        token = sketch[np.arange(n), place].astype(np.uint64) | place.astype(np.uint64) << U64(16) | U64(d + 1) << U64(32)
        key = mix(key + mix(token))
        out[:, d] = key
    return out


def _labels(linked: np.ndarray) -> np.ndarray:
    """The smallest member reachable by links, for a small symmetric matrix."""
    n = len(linked)
    linked = linked | np.eye(n, dtype=bool)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        if (new == label).all():
            return label
        label = new


def runs_for(depth: int, threshold: float) -> int:
    """Runs after which at most MISSED of the pairs at the threshold never survived ``depth`` splits together."""
    stay = min(threshold**depth, 1 - 1e-12)
    return max(RUNS, math.ceil(math.log(MISSED) / math.log1p(-stay) - 1e-9))


def candidate_groups(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) candidate links between ``sets`` (id, sketch): a spanning forest per bucket.

    The first runs take all sets. Sets of buckets that went on beyond MIN_DEPTH need more runs; there, buckets whose sets
    are connected already have nothing to add and are left.
    """
    first = max(RUNS, runs_for(MIN_DEPTH, threshold))
    found, hot, depth = _runs(sets.select("id", "sketch", F.col("id").alias("part")), range(first))
    needed = runs_for(depth, threshold)
    if hot is not None and needed > first:
        parts = saved(components(found), "candidate-parts")
        more = sets.select("id", "sketch").join(saved(hot.distinct(), "hot-sets"), "id", "left_semi").join(parts, F.col("id") == F.col("node"), "left")
        more = saved(more.select("id", "sketch", F.coalesce("component", "id").alias("part")), "hot-sketches")
        found = parts.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = found.unionByName(_runs(more, range(first, needed))[0])
    return found


def _runs(sets: DataFrame, runs: range) -> tuple[DataFrame, DataFrame | None, int]:
    """Candidate links of some runs, the sets that were in a bucket too large at MIN_DEPTH, and the deepest split reached.

    Sets of one ``part`` are known to be connected.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            sketch = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint16).reshape(n, -1)
            for r in runs:
                keys = paths(sketch, r)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("part"), *(pa.array(signed(keys[:, d])) for d in range(MIN_DEPTH - 1, MAX_DEPTH))],
                                                 ["id", "part", *(f"k{d + 1}" for d in range(MIN_DEPTH - 1, MAX_DEPTH))])

    names = [f"k{d}" for d in range(MIN_DEPTH, MAX_DEPTH + 1)]
    state = sets.select("id", "part", "sketch").mapInArrow(spread, "id long, part long, " + ", ".join(f"{k} long" for k in names))
    small, deep, hot, reached = None, None, None, MIN_DEPTH
    for depth, k in enumerate(names, MIN_DEPTH):
        # written first: a join straight on an aggregation could not be split at a bucket of very many sets
        sizes = state.groupBy(k).agg(F.count("*").alias("size"), F.min("id").alias("least"), F.min("part").alias("low"), F.max("part").alias("high"))
        sizes = saved(sizes.where("low < high").drop("low", "high"), "path-sizes")
        state = saved(state.join(sizes, k), "paths")
        found = state.where(F.col("size") <= SMALL).select(F.col(k).alias("bucket"), "id")
        small = found if small is None else small.unionByName(found)
        state = state.where(F.col("size") > SMALL)
        if not sizes.where(F.col("size") > SMALL).isEmpty():
            hot = state.select("id") if hot is None else hot
            reached = min(depth + 1, MAX_DEPTH)
        if depth == MAX_DEPTH:
            deep = state.select(F.col("id").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        state = state.drop("size", "least", k)

    def search(bucket: pa.Table) -> pa.RecordBatch:
        ids = np.asarray(bucket.column("id"))
        ids, at = np.unique(ids, return_index=True)
        sketch = np.frombuffer(b"".join(bucket.column("sketch").to_pylist()), np.uint16).reshape(bucket.num_rows, -1)[at]
        same = np.stack([(sketch == x).mean(axis=1) for x in sketch])
        label = _labels(same >= SKETCH_SHARE)
        off = label != np.arange(len(ids))
        return pa.RecordBatch.from_arrays([pa.array(ids[off]), pa.array(ids[label[off]])], ["a", "b"])

    members = small.join(sets.select("id", "sketch"), "id")
    return by_groups(members, ["bucket"], search, "a long, b long").unionByName(deep), hot, reached


def verified(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, links, least) from (grp, p, q, block, id, copies, shingles): links of block p with block q of a group.

    links: documents behind the linked classes; least: the smallest class reachable by links seen in this task.
    """

    def verify(part: pa.Table) -> pa.RecordBatch:
        p, q = part.column("p")[0].as_py(), part.column("q")[0].as_py()
        part = part.take(np.unique(np.asarray(part.column("id")), return_index=True)[1])  # repeated rows
        ids = np.asarray(part.column("id"))
        block = np.asarray(part.column("block"))
        copies = np.asarray(part.column("copies"))
        sets = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), size)
        keep = count[column] > 1  # a shingle of one set is in no intersection
        row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        step = max(1, (4 << 20) // max(1, len(sets)))
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [low, low + step])
            grid = np.zeros((len(sets), min(step, int(column[-1]) + 1 - low)), np.float32)
            grid[row[a:b], column[a:b] - low] = 1
            common += grid @ grid.T
        linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        if p != q:
            linked &= block[:, None] != block[None, :]
        label = _labels(linked)
        # ids ascend, so the smallest index is the smallest id
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64)), pa.array(ids[label])],
                                          ["id", "links", "least"])

    return by_groups(members, ["grp", "p", "q"], verify, "id long, links long, least long")


def similarity_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """(id, class_id, n_links) of each id: the smallest id reachable by links, and the number of linked rows."""
    prepare(docs.sparkSession)
    # rows of one id: the one of the smallest set hash
    feats = features(docs, id_col, text_col, width).groupBy("id").agg(F.min(F.struct("h1", "h2", "n", "sketch")).alias("x")).select("id", "x.*")
    feats = saved(feats, "shingle-sketches")
    classes = feats.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    named = saved(feats.select("id", "h1", "h2").join(classes, ["h1", "h2"], "left").select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies")), "set-classes")
    reps = named.where("id = rep").select("id", "copies")
    names = feats.select("id", "h1", "h2")
    sets = feats.where("n > 0").join(reps.select("id"), "id", "left_semi")
    grouped_ids = components(candidate_groups(sets, threshold))
    # written first: a join straight on an aggregation could not be split at a component of very many sets
    sizes = saved(grouped_ids.groupBy("component").agg(F.count("*").alias("size")), "component-sizes")
    chosen = (grouped_ids.join(sizes, "component").join(reps, F.col("node") == F.col("id")).join(names, "id").select("id", "copies", "h1", "h2", F.col("component").alias("grp"),
              F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = shingle_sets(b.column("text"), width)
            h1, h2 = set_hashes(seeded(h, 7), first)
            same = (h1 == np.asarray(b.column("h1"))) & (h2 == np.asarray(b.column("h2")))
            if not same.all():  # another row of the id stands for it
                h, keep = h[np.repeat(same, np.diff(first))], pa.array(same)
                first, b = np.concatenate([[0], np.cumsum(np.diff(first)[same])]), b.filter(keep)
            packed = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(h.tobytes())])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("grp", "blocks", "block", "id", "copies")), packed], ["grp", "blocks", "block", "id", "copies", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    members = texts.join(chosen, "id").mapInArrow(collect, "grp long, blocks int, block int, id long, copies long, shingles binary")
    members = (members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")))
    found = saved(verified(members, threshold), "verified-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.where("least <> id").select(F.col("id").alias("a"), F.col("least").alias("b")))
    return (named.join(links.withColumnRenamed("id", "rep"), "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
            .select("id", F.coalesce("component", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
