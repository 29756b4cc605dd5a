"""Exact removal of repeated byte strings (operator 4): radix passes over suffixes, limited to the threshold depth.

A byte is removed if it lies in a DEPTH-byte string of its text that also starts in a document with a smaller id.
Ordering every suffix of the corpus would shuffle many times its size, so each pass refines only what the pass
before it left undecided, and suffixes are looked at only through their first DEPTH bytes:

1. First digit: the smallest hash among the ANCHOR-byte strings inside a DEPTH-byte window. Equal windows have equal
   digits, and neighbouring windows mostly share one, so a *run* of windows is one entry. Distinct (digit, group)
   entries are dealt out by digit; those that lie in one group of documents alone are decided.
2. Second digit: the hash of all bytes under a run. A run whose bytes are found in an earlier group is repeated as a
   whole; first holders whose digit occurs with other bytes as well stay undecided.
3. Last digit: the DEPTH-byte windows of the undecided runs, by hash. A window is repeated if an earlier group has it.
4. Inside a group (a range of document ids of about GROUP_BYTES) windows with a common first digit are ordered by
   most-significant-digit passes over their bytes, eight at a time; only groups with two documents go on.

Groups are ranges of ids, so "an earlier group" means smaller ids, an entry needs no document id, and a string that
every document holds is one entry per group: the hottest key has as many rows as there are groups. Passes 2 to 4
read the same exchange of the texts. Keys are 64-bit hashes in passes 1 to 3.

Null texts count as empty. Rows with a null id neither lose bytes nor make others lose any. Rows that share an id do
not remove each other's bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Rolling, prepare, row_slices, saved, signed, slices, text_buffer

DEPTH = 50
ANCHOR = 20
GROUP_BYTES = 8 << 20


def runs(buf: np.ndarray, offsets: np.ndarray, rolling: Rolling, depth: int = DEPTH, anchor: int = ANCHOR):
    """Runs of window starts with one first digit: digit, first start, last start, row."""
    n = len(buf) - depth + 1
    if n <= 0:
        e = np.empty(0, np.int64)
        return e.astype(np.uint64), e, e, e
    low = rolling.windows(anchor)
    reach = depth - anchor + 1
    width = 1
    while width * 2 <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: len(low) - (reach - width)], low[reach - width:])
    # windows must lie in one row: a row's last depth-1 starts are none
    inside = np.zeros(len(buf) + 1, np.int32)
    size = np.diff(offsets)
    has = size >= depth
    np.add.at(inside, offsets[:-1][has], 1)
    np.add.at(inside, offsets[1:][has] - depth + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    change = np.ones(n, bool)
    change[1:] = low[1:] != low[:-1]
    at_row = offsets[:-1][has]
    change[at_row] = True
    change[1:] |= inside[1:] & ~inside[:-1]
    begin = np.flatnonzero(change & inside)
    stop = np.ones(n, bool)  # the last start of a run: outside or another run next
    stop[:-1] = change[1:] | ~inside[1:]
    end = np.flatnonzero(stop & inside)
    return low[begin], begin, end, np.searchsorted(offsets, begin, "right") - 1


def repeated_windows(buf: np.ndarray, starts: np.ndarray, owner: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Which window starts hold bytes that also start in a row of a smaller owner: radix passes, 8 bytes each."""
    out = np.zeros(len(starts), bool)
    live = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    for at in range(0, depth, 8):
        if not len(live):
            return out
        size = min(8, depth - at)
        digit = np.zeros((len(live), 8), np.uint8)
        digit[:, :size] = buf[(starts[live] + at)[:, None] + np.arange(size)]
        digit = digit.view(np.uint64).ravel()
        order = np.lexsort((digit, group))
        live, group, digit = live[order], group[order], digit[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        several = np.minimum.reduceat(owner[live], first) < np.maximum.reduceat(owner[live], first)
        keep = several[group]
        live, group = live[keep], group[keep]
    if len(live):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        least = np.repeat(np.minimum.reduceat(owner[live], first), np.diff(np.append(first, len(live))))
        out[live] = owner[live] > least
    return out


def _expand(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = end - begin + 1
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _replies(table: pa.Table, kind: int) -> np.ndarray:
    k = np.asarray(table.column("key"), np.int64)
    return np.sort(k[np.asarray(table.column("kind"), np.int64) == kind].view(np.uint64))


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, depth: int = DEPTH, anchor: int = ANCHOR,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, spans array<struct<start, end>> of removed bytes, kept binary) of each row."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    nameless = rows.where("id is null")
    rows = rows.where("id is not null")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_groups = max(1, math.ceil(size / group_bytes))
    bounds = sorted(set(rows.approxQuantile("id", [i / n_groups for i in range(1, n_groups)], 0.25 / n_groups))) if n_groups > 1 else []
    edges = np.array(bounds, np.float64)
    n_groups = len(edges) + 1
    partitions = max(n_groups, int(spark.conf.get("spark.sql.shuffle.partitions")))

    @F.pandas_udf("int")
    def group_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), "right").astype(np.int32))

    def first_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, offsets = text_buffer(b.column("text"))
            digit, _, _, row = runs(buf, offsets, Rolling(buf), depth, anchor)
            g = np.searchsorted(edges, np.asarray(b.column("id")), "right")[row]
            order = np.lexsort((digit, g))
            digit, g = digit[order], g[order]
            new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (g[1:] != g[:-1])]) if len(digit) else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(signed(digit[new])), pa.array(g[new].astype(np.int32))], ["key", "g"])

    entries = rows.mapInArrow(first_digits, "key long, g int")
    w = Window.partitionBy("key")
    shared = (entries.withColumn("lo", F.min("g").over(w)).withColumn("hi", F.max("g").over(w)).where("lo < hi")
              .select("g", F.lit(1).alias("kind"), "key"))
    dealt = rows.withColumn("g", group_of("id")).repartition(partitions, "g")

    def answered(replies: DataFrame, fn, schema: str) -> DataFrame:
        return dealt.groupBy("g").cogroup(replies.repartition(partitions, "g").groupBy("g")).applyInArrow(fn, schema)

    def scan(buf: np.ndarray, offsets: np.ndarray):
        """Runs of a group, some rows at a time: their hashes, and for each run digit, key, first start, last start, row."""
        for a, b in row_slices(offsets):
            low = int(offsets[a])
            part = buf[low:int(offsets[b])]
            rolling = Rolling(part)
            digit, begin, end, row = runs(part, offsets[a:b + 1] - low, rolling, depth, anchor)
            yield low, rolling, digit, rolling.ranges(begin, end + depth), begin, end, row + a

    def second_digits(texts: pa.Table, replies: pa.Table) -> pa.Table:
        empty = pa.table({"first": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "g": pa.array([], pa.int32())})
        if not texts.num_rows or not replies.num_rows:
            return empty
        g = texts.column("g")[0].as_py()
        known, digits, keys = _replies(replies, 1), [], []
        for _, _, digit, key, _, _, _ in scan(*text_buffer(texts.column("text"))):
            pick = _member(digit, known)
            digits.append(digit[pick])
            keys.append(key[pick])
        digit = np.concatenate(digits)
        key, at = np.unique(np.concatenate(keys), return_index=True)
        return pa.table({"first": signed(digit[at]), "key": signed(key), "g": pa.array(np.full(len(key), g, np.int32))})

    w = Window.partitionBy("key")
    seconds = saved(answered(shared, second_digits, "first long, key long, g int").withColumn("lo", F.min("g").over(w)), "suffix-runs")
    covered = seconds.where("lo < g").select("g", F.lit(2).alias("kind"), "key")
    holders = seconds.where("lo = g")
    diverse = holders.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first")
    undecided = holders.join(diverse, "first", "left_semi").select("g", F.lit(3).alias("kind"), "key")

    def last_digits(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows or not replies.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "g": pa.array([], pa.int32())})
        g = texts.column("g")[0].as_py()
        asked, keys = _replies(replies, 3), []
        for _, rolling, _, key, begin, end, _ in scan(*text_buffer(texts.column("text"))):
            pick = _member(key, asked)
            at = _expand(begin[pick], end[pick])
            keys.append(np.unique(rolling.ranges(at, at + depth)))
        key = np.unique(np.concatenate(keys))
        return pa.table({"key": signed(key), "g": pa.array(np.full(len(key), g, np.int32))})

    lasts = (answered(undecided, last_digits, "key long, g int").withColumn("lo", F.min("g").over(w)).where("lo < g")
             .select("g", F.lit(4).alias("kind"), "key"))

    def cut(texts: pa.Table, replies: pa.Table) -> pa.Table:
        buf, offsets = text_buffer(texts.column("text"))
        ids = np.asarray(texts.column("id"), np.int64)
        covered, asked, known = (_replies(replies, k) if replies.num_rows else np.empty(0, np.uint64) for k in (2, 3, 4))
        marks = np.zeros(len(buf) + 1, np.int32)  # where removed strings begin, less where they end
        held = []
        for low, rolling, digit, key, begin, end, row in scan(buf, offsets):
            whole = _member(key, covered)
            np.add.at(marks, begin[whole] + low, 1)
            np.add.at(marks, end[whole] + low + depth, -1)
            # runs that other groups could not cover: by window, against earlier groups ...
            rest = ~whole & _member(key, asked)
            at = _expand(begin[rest], end[rest])
            at = at[_member(rolling.ranges(at, at + depth), known)] + low
            np.add.at(marks, at, 1)
            np.add.at(marks, at + depth, -1)
            held.append((digit, begin + low, end + low, row))
        if held:
            # ... and against smaller ids of this group
            digit, begin, end, row = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(digit, kind="stable")
            digit, begin, end, owner = digit[order], begin[order], end[order], ids[row[order]]
            first = np.flatnonzero(np.concatenate([[True], digit[1:] != digit[:-1]])) if len(digit) else np.empty(0, np.int64)
            bounds = np.append(first, len(digit))
            several = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first) if len(first) else np.empty(0, bool)
            # whole digits at a time, so that about SLICE_BYTES windows are ordered at once
            picked = np.flatnonzero(several)
            size = np.add.reduceat(end - begin + 1, first)[picked] if len(first) else np.empty(0, np.int64)
            for a, b in row_slices(np.concatenate([[0], np.cumsum(size)]), SLICE_BYTES // 8):
                runs_of = _expand(bounds[picked[a:b]], bounds[picked[a:b] + 1] - 1)
                at = _expand(begin[runs_of], end[runs_of])
                at = at[repeated_windows(buf, at, np.repeat(owner[runs_of], end[runs_of] - begin[runs_of] + 1), depth)]
                np.add.at(marks, at, 1)
                np.add.at(marks, at + depth, -1)
        gone = np.cumsum(marks[:-1]) > 0
        return _result(texts.column("id"), buf, offsets, gone)

    replies = covered.unionByName(undecided).unionByName(lasts)
    out = answered(replies, cut, _SCHEMA)

    def untouched(batches):
        for b in slices(batches, "text"):
            buf, offsets = text_buffer(b.column("text"))
            yield from _result(b.column("id"), buf, offsets, np.zeros(len(buf), bool)).to_batches()

    return out.unionByName(nameless.mapInArrow(untouched, _SCHEMA))


_SCHEMA = "id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"


def _result(ids, buf: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> pa.Table:
    n = len(offsets) - 1
    removed = np.concatenate([[0], np.cumsum(gone)])[offsets]
    begin = gone.copy()
    finish = gone.copy()
    if len(buf):
        row_start = np.zeros(len(buf) + 1, bool)
        row_start[offsets] = True
        begin[1:] &= ~gone[:-1] | row_start[1:-1]
        finish[:-1] &= ~gone[1:] | row_start[1:-1]
    b, e = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    count = np.searchsorted(b, offsets)
    base = np.repeat(offsets[:-1], np.diff(count))
    spans = pa.ListArray.from_arrays(pa.array(count, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(b - base, pa.int32()), pa.array(e - base, pa.int32())], ["start", "end"]))
    kept_at = offsets - removed
    kept = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept_at.astype(np.int64)), pa.py_buffer(buf[~gone])]).cast(pa.binary())
    return pa.table({"id": ids, "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(np.diff(removed), pa.int64()),
                     "spans": spans, "kept": kept})
