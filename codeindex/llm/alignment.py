"""Alignment of two tokenizers' ids on the same text (operator 11).

Tokens of both vocabularies are byte ranges of a space and the text. Where a token of each ends at the same byte,
both id lists are cut: the cumulative ends of either side are a dictionary from end to index, the hash-set
intersection of their keys, sorted, slices both lists into groups (``common_ends``), and inside a slice every pair of
tokens that overlap is a link (``expand_links``).

1. White space that follows other characters always starts a token on both sides, so both end before it and no group
   or link reaches over it. A worker therefore keeps groups and links of the pieces it has met (compared by their
   bytes), and a text is a run of pieces. Texts are dealt with where they are scanned, in blocks of about
   ``BLOCK_BYTES``: a document is a row with the places of its id pairs in the block's list of pairs, and a
   block gives one row per different pair with the number of its documents that hold it linked.
2. Pair counts of the whole corpus are sums of those rows, so a pair of every document is one row per block. A pair
   is the best of its first id if no other has more documents (``best``, ties included).
3. Counts go back to the blocks, one row per pair and block, and meet the block's documents there.

Null and empty texts have no tokens, nor have texts whose bytes either side does not give back (U+2581 is a space to
the second): zeros and an empty group text. Rows are independent: repeated rows are documents of their own, rows of a
null id keep it, ties between pairs all count as best. An empty table gives an empty one. A text longer than a block
is a block of its own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import distinct, prepare, ragged, release, saved, slices, text_buffer
from .tokenizing import ODD_SPACE, PieceEncoder, byte_characters

BLOCK_BYTES = 8 << 20
# Pieces kept by a worker, and the bytes of their texts; it starts anew when full, which changes no result.
CACHE_PIECES = 200_000
CACHE_BYTES = 24 << 20
AT_ONCE = 10_000  # pieces that are encoded in one go
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets where both sides have an end, in order, and how many tokens of either side end up to each."""
    at_a, at_b = (dict(zip(ends.tolist(), range(1, len(ends) + 1), strict=True)) for ends in (ends_a, ends_b))
    common = sorted(at_a.keys() & at_b.keys())
    return (np.array(common, np.int64), *(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b)))


def expand_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links as byte end and token index of either side: the ends of a slice differ but for its last one, so each end of
    either side closes one overlap, with the token of the other side that is still open there."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class TwoEncoders:
    """Ids and token bytes under both vocabularies; see ``align`` for the two files."""

    def __init__(self, byte_json: str, pattern: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.first = PieceEncoder(byte_json, pattern, False)
        of = {c: b for b, c in byte_characters().items()}
        vocab = self.first.tokenizer.get_vocab()
        names = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            names[i] = bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
        sp = self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces of this model reach over spaces")
        self.sides = [TokenBytes(names), TokenBytes([bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])]
        self.space = sp.piece_to_id("▁")
        top = max(len(names), len(pieces))
        self.spelled = [f"{i}{mark}" for i in range(top) for mark in ",|;"]
        self.widths = np.fromiter(map(len, self.spelled), np.int64, 3 * top)

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both sides, all ids of the texts and how many each has. Texts begin with a space, which the second library
        adds by itself."""
        a = list(map(self.first.ids_of, texts))
        b = self.second.encode([t[1:] for t in texts])
        out = []
        for lists in (a, [x if len(t) > 1 else [self.space] for t, x in zip(texts, b, strict=True)]):
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            out.append((np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n))
        return out


class TokenBytes:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def differ(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For texts of ``sizes`` bytes in ``data``: whether the bytes of a text's ids differ from it."""
        lengths = self.lengths[ids]
        own = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        bad = np.diff(own) != sizes
        same = ragged(self.flat, self.starts[ids], lengths)
        fine, size = ~bad, sizes[~bad]
        wrong = ragged(same, own[:-1][fine], size) != ragged(data, (np.cumsum(sizes) - sizes)[fine], size)
        total = np.concatenate([[0], np.cumsum(wrong)])[np.concatenate([[0], np.cumsum(size)])]
        bad[np.flatnonzero(fine)[total[1:] > total[:-1]]] = True
        return bad


class Pieces:
    """Groups and links of the pieces met so far."""

    def __init__(self, encoders: TwoEncoders):
        self.encoders = encoders
        self.reset()

    def reset(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.held = 0
        self.groups: list[str] = []
        self.numbers = np.empty((4, 0), np.int64)  # of each piece: ids of both sides, groups, 1 if its bytes differ
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self.links = np.empty(0, np.int32)  # places in pairs
        self.pair_at: dict[int, int] = {}
        self.pairs = np.empty(0, np.int64)

    def full(self, more: int) -> bool:
        return bool(self.slot) and (len(self.slot) + more > CACHE_PIECES or self.held > CACHE_BYTES)

    def learn(self, names: list[bytes]) -> np.ndarray:
        """Slots of the pieces ``names`` (all different)."""
        fresh = [x for x in names if x not in self.slot]
        if fresh:
            self.slot.update(zip(fresh, range(len(self.slot), len(self.slot) + len(fresh)), strict=True))
            self.held += sum(map(len, fresh))
            for i in range(0, len(fresh), AT_ONCE):
                self._append(fresh[i:i + AT_ONCE])
        return np.fromiter(map(self.slot.__getitem__, names), np.int64, len(names))

    def _append(self, names: list[bytes]) -> None:
        """Groups and links of ``names`` as the next slots, all in one go: one after another they are one long text."""
        both = self.encoders
        (ids_a, n_a), (ids_b, n_b) = both([x.decode("utf-8", "replace") for x in names])
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        data = np.frombuffer(b"".join(names), np.uint8)
        bad = both.sides[0].differ(ids_a, n_a, data, sizes) | both.sides[1].differ(ids_b, n_b, data, sizes)
        if bad.any():  # such pieces have no tokens
            ids_a, ids_b = ids_a[np.repeat(~bad, n_a)], ids_b[np.repeat(~bad, n_b)]
            n_a, n_b, sizes = (np.where(bad, 0, x) for x in (n_a, n_b, sizes))
        last = np.concatenate([[0], np.cumsum(sizes)])  # byte ends of the pieces
        ends_a, ends_b = np.cumsum(both.sides[0].lengths[ids_a]), np.cumsum(both.sides[1].lengths[ids_b])
        common, upto_a, upto_b = common_ends(ends_a, ends_b)
        n_groups = np.diff(np.searchsorted(common, last, "right"))
        # both ids of a group one after the other, each with the mark that follows it
        before_a, before_b = (np.concatenate([[0], x[:-1]]) for x in (upto_a, upto_b))
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        mark_a[upto_a - 1], mark_b[upto_b - 1] = 1, 2
        code[np.arange(len(ids_a)) + np.repeat(before_b, upto_a - before_a)] = 3 * ids_a + mark_a
        code[np.arange(len(ids_b)) + np.repeat(upto_a, upto_b - before_b)] = 3 * ids_b + mark_b
        text = "".join(map(both.spelled.__getitem__, code.tolist()))
        at = np.concatenate([[0], np.cumsum(both.widths[code])])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        self.groups += [text[i:j - 1] if j > i else "" for i, j in pairwise(at)]
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_groups, bad.astype(np.int64)])], axis=1)
        ends, i, j = expand_links(ends_a, ends_b)
        lengths = np.diff(np.searchsorted(ends, last, "right"))
        self.starts = np.concatenate([self.starts, len(self.links) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        pairs, which = np.unique(ids_a[i] << 32 | ids_b[j], return_inverse=True)
        known, of = len(self.pairs), self.pair_at
        place = np.fromiter((of.setdefault(x, len(of)) for x in pairs.tolist()), np.int32, len(pairs))
        self.links = np.concatenate([self.links, place[which.reshape(-1)]])
        if len(of) > known:
            new = np.empty(len(of) - known, np.int64)
            new[place[place >= known] - known] = pairs[place >= known]
            self.pairs = np.concatenate([self.pairs, new])


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A space and each text (nothing for a null or empty one): bytes, text offsets, piece starts, first piece of each text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    blank, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    spaced = pc.if_else(pc.equal(texts, blank), blank, pc.binary_join_element_wise(space, texts, blank))
    buf, offsets = text_buffer(spaced)
    begin = np.zeros(len(buf) + 1, bool)
    if len(buf):
        begin[1:-1] = (buf[1:] == 32) & ~_WHITE[buf[:-1]]
        for i in np.flatnonzero(np.asarray(pc.match_substring_regex(texts, ODD_SPACE))):
            begin[offsets[i]:offsets[i + 1]] = False
        begin[offsets] = True
    begin[-1] = False
    starts = np.flatnonzero(begin)
    return buf, offsets, starts, np.searchsorted(starts, offsets)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of each one's weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


_PIECES: dict[tuple, Pieces] = {}


def pieces_of(byte_json: str, pattern: str, piece_model: bytes) -> Pieces:
    """The pieces of this Python worker, which outlive a task."""
    key = (hash(byte_json), pattern, hash(piece_model))
    if key not in _PIECES:
        _PIECES.clear()
        _PIECES[key] = Pieces(TwoEncoders(byte_json, pattern, piece_model))
    return _PIECES[key]


class Block:
    """Documents gathered by a task until they are a block."""

    def __init__(self, number: int, kind: pa.DataType, keep_groups: bool):
        self.number, self.kind, self.keep = number, kind, keep_groups
        self.rows: list[pa.RecordBatch] = []
        self.docs: list[np.ndarray] = []  # of each (document, pair) in ascending order: document, pair, occurrences
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = self.n = 0

    def add(self, batch: pa.RecordBatch, pieces: Pieces, parts) -> None:
        buf, offsets, starts, first, names, which = parts
        slot = pieces.learn(names)[which] if len(starts) else np.empty(0, np.int64)
        n = batch.num_rows
        total = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(pieces.numbers[:, slot], axis=1)], axis=1)[:, first]
        a, b, groups, bad = np.diff(total, axis=1)
        links = np.diff(np.concatenate([[0], np.cumsum(pieces.lengths[slot])])[first])
        fine = (bad == 0) & (np.diff(first) > 0)
        texts, names = [pieces.groups[k] for k in slot.tolist()], first.tolist()
        spelled = [";".join(texts[i:j]) if ok else "" for i, j, ok in zip(names[:-1], names[1:], fine.tolist(), strict=True)]
        digest = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in spelled]
        columns = [batch.column("id"), *(pa.array(np.where(fine, x, 0)) for x in (a, b, groups, links)), pa.array(digest)]
        self.rows.append(pa.RecordBatch.from_arrays(columns + [pa.array(spelled if self.keep else [None] * n, pa.string())],
                                                    ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]))
        row = np.repeat(np.arange(n), np.diff(first))
        good = fine[row]
        width = max(1, len(pieces.slot))
        key, times = summed(row[good] * width + slot[good], np.ones(int(good.sum()), np.int64))
        slot, row = key % width, key // width
        lengths = pieces.lengths[slot]
        width = max(1, len(pieces.pairs))
        key, times = summed(np.repeat(row, lengths) * width + ragged(pieces.links, pieces.starts[slot], lengths), np.repeat(times, lengths))
        self.docs.append((key // width + self.n).astype(np.int32))
        self.pairs.append((key % width).astype(np.int32))
        self.times.append(times.astype(np.uint32))
        self.n += n
        self.size += len(buf)

    def batches(self, pieces: Pieces) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, then rows of the block's pairs in ascending order."""
        doc, pair, times = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (self.docs, self.pairs, self.times))
        holders = np.bincount(pair, minlength=len(pieces.pairs))
        used = np.flatnonzero(holders)
        used = used[np.argsort(pieces.pairs[used])]
        place = np.zeros(len(pieces.pairs), np.uint32)
        place[used] = np.arange(len(used), dtype=np.uint32)
        cuts = np.searchsorted(doc, np.arange(self.n + 1))
        at = 0
        for rows in self.rows:
            n = rows.num_rows
            lists, counts = [], []
            for i, j in pairwise(cuts[at:at + n + 1].tolist()):
                lists.append(place[pair[i:j]].astype("<u4").tobytes())
                t = times[i:j]
                counts.append(t.astype("u1" if not len(t) or t.max() < 256 else "<u4").tobytes())
            at += n
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, self.number)), none, none, *rows.columns, pa.array(lists, pa.binary()), pa.array(counts, pa.binary())],
                                             ["block", "pair", "docs", *rows.schema.names, "pairs", "times"])
        for i in range(0, len(used), 50_000):
            some = used[i:i + 50_000]
            n = len(some)
            blank = [pa.nulls(n, t) for t in (self.kind, *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, self.number)), pa.array(pieces.pairs[some]), pa.array(holders[some]), *blank],
                                             ["block", "pair", "docs", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "times"])


def scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with sums over the counts of its pairs."""
    counts = counts.sort_by("pair")
    n, best = np.asarray(counts.column("n"), np.int64), np.asarray(counts.column("best").cast(pa.int8()), np.int64)
    sums, tops = [], []
    for pairs, times in zip(docs.column("pairs").to_pylist(), docs.column("times").to_pylist(), strict=True):
        at = np.frombuffer(pairs, "<u4")
        often = np.frombuffer(times, "u1" if len(times) == len(at) else "<u4").astype(np.int64)
        sums.append(int((n[at] * often).sum()))
        tops.append(int((best[at] * often).sum()))
    out = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(tops, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
    return out.append_column("groups_sha256", docs.column("groups_sha256")).append_column("groups", docs.column("groups"))


def align(docs: DataFrame, id_col: str, text_col: str, byte_json: str, pattern: str, piece_model: bytes,
          keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents and links of ``docs`` under a byte-level tokenizer (its JSON and split pattern) and a piece model.

    Documents: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups), the last one (the groups
    spelled ``a1,a2|b1;a3|b2``) only if ``keep_groups``, else null. Links: (a, b, n, best) of every linked id pair.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((byte_json, piece_model))  # two public vocabularies of fixed size
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        js, model = shared.value
        pieces = pieces_of(js, pattern, model)
        number = TaskContext.get().partitionId() << 32
        block = None
        for b in slices(batches, "text"):
            buf, offsets, starts, first = cut(b.column("text"))
            names, which = distinct(buf, np.append(starts, len(buf))) if len(starts) else (pa.array([], pa.binary()), starts)
            again = pieces.full(len(names))
            if block is not None and (again or block.size >= BLOCK_BYTES):
                yield from block.batches(pieces)
                block = None
                release()
            if again:
                pieces.reset()
            if block is None:
                block = Block(number, b.schema.field("id").type, keep_groups)
                number += 1
            block.add(b, pieces, (buf, offsets, starts, first, names.to_pylist(), which))
        if block is not None:
            yield from block.batches(pieces)
        release()

    columns = "n_a long, n_b long, n_groups long, n_links long"
    made = saved(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"block long, pair long, docs long, id {kind}, {columns}, groups_sha256 string, groups string, pairs binary, times binary"), "alignment")
    held = made.where("pair is not null").select("block", "pair", "docs")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32))
    # an id of the first vocabulary has at most as many pairs as the second vocabulary has ids
    links = saved(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a"))), "pair-counts")
    known = held.select(F.col("block").alias("of"), "pair").join(links.select("pair", "n", "best"), "pair")
    own = made.where("pair is null").drop("pair", "docs")
    documents = own.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        scored, f"id {kind}, {columns}, n_best long, count_sum long, groups_sha256 string, groups string")
    return documents, links.select(F.col("a").cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n", "best")
