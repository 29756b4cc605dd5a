"""Token ids in a compact binary file (operator 10): canonical, length-limited Huffman coding.

1. ``tokenise``: ids of each whole text with the end id behind them, packed in rows of about ``SEGMENT_IDS`` ids in
   ascending order of the document id. Texts are tokenised where they are scanned, once; only ids are shuffled, by
   ranges of the document id that its quantiles give.
2. ``code_lengths``: package-merge over the global counts of the ids (one number per entry of the vocabulary),
   limited to 16 bits.
3. ``encode``: each segment becomes one record of the file format: canonical codes, most significant bit first, in
   blocks of ``BLOCK_IDS`` ids, with the bit offset of every block as a checkpoint.
4. ``decode``: blocks are independent. All blocks of several segments are decoded side by side by one 2**16-entry table.

The file is a Parquet folder of such records (Spark's committer makes its writing safe against lost executors) next
to a codebook folder (id, bits). Nulls: a null text is empty, so it holds the end id alone. Null document ids come first. Rows that share an
id stay separate documents, next to each other. An empty table gives an empty file; a text longer than a segment is a
segment of its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, saved, scratch, slices
from .tokenizing import worker_encoder

MAX_BITS = 16
BLOCK_IDS = 512
SEGMENT_IDS = 1 << 17
TOGETHER_IDS = 8 * SEGMENT_IDS  # segments that start within so many ids are decoded side by side
BUCKETS = 4  # ranges of document ids per partition, so that their hashes spread evenly


def tokenise(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, pattern: str, lower: bool, end_id: int, width: int = 4,
             edges: np.ndarray | None = None) -> DataFrame:
    """(id, ids binary): little-endian unsigned ids of ``width`` bytes of each text, ``end_id`` last.

    With ``edges`` (ascending ids) also ``bucket``: ids below the first edge are in bucket 0, and so on. An id that is
    several edges, as very many rows have it, is dealt out over the buckets between them.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a public vocabulary of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value, pattern, lower)
        for b in slices(batches, "text"):
            ids, first = encoder.encode(b.column("text"))
            ids = np.insert(ids, first[1:], end_id)
            first = (first + np.arange(len(first))) * width
            packed = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(ids.astype(f"<u{width}"))])
            if edges is None:
                yield pa.RecordBatch.from_arrays([b.column("id"), packed], ["id", "ids"])
                continue
            value = np.asarray(pc.fill_null(b.column("id"), 0).cast(pa.float64()))
            low, high = (np.searchsorted(edges, value, side) for side in ("left", "right"))
            bucket = np.where(high - low > 1, low + 1 + (np.arange(len(value)) + len(ids)) % np.maximum(1, high - low), high)
            bucket[np.asarray(b.column("id").is_null())] = 0
            yield pa.RecordBatch.from_arrays([b.column("id"), packed, pa.array(bucket, pa.int32())], ["id", "ids", "bucket"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids binary" + ("" if edges is None else ", bucket int"))


def edges_of(ids: DataFrame, buckets: int) -> np.ndarray:
    """Up to ``buckets`` - 1 ids that part the rows into ranges of about equal size; a hot id is an edge several times."""
    at = [i / buckets for i in range(1, buckets)]
    return np.array(sorted(ids.approxQuantile(ids.columns[0], at, 0.25 / buckets)) if at else [], np.float64)


def segments(tokens: DataFrame, partitions: int) -> DataFrame:
    """Rows (part, start_in_part, doc_ids, counts, ids) in ascending document order; every row holds whole documents.

    Ids travel as two bytes each. A part is a bucket of ``tokens`` where they have one, else a range of ids; finding
    ranges reads ``tokens`` once more.
    """
    kind = tokens.schema["id"].dataType.simpleString()
    dealt = "bucket" in tokens.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = None if dealt else TaskContext.get().partitionId(), 0
        names, held, size = [], [], 0

        def flush():
            nonlocal names, held, size, start
            ids = np.frombuffer(b"".join(held), "<u2")
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([names], pa.list_(id_type)),
                pa.array([[len(x) // 2 for x in held]], pa.list_(pa.int32())), pa.array([ids.tobytes()], pa.binary())],
                ["part", "start_in_part", "doc_ids", "counts", "ids"])
            start += len(ids)
            names, held, size = [], [], 0
            return row

        id_type = None
        for b in batches:
            id_type = b.schema.field("id").type
            buckets = b.column("bucket").to_pylist() if dealt else [part] * b.num_rows
            for name, x, bucket in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), buckets, strict=True):
                if bucket != part:
                    if held:
                        yield flush()
                    part, start = bucket, 0
                names.append(name)
                held.append(x)
                size += len(x) // 2
                if size >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()

    if dealt:
        ordered = tokens.repartition(partitions, "bucket").sortWithinPartitions("bucket", "id")
    else:
        ordered = tokens.repartitionByRange(partitions, "id").sortWithinPartitions("id")
    return ordered.mapInArrow(run, f"part int, start_in_part long, doc_ids array<{kind}>, counts array<int>, ids binary")


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol (0: not used) of an optimal code limited to ``most`` bits, by package-merge."""
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        bits[used] = 1
        return bits
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols do not fit in {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.int64)
    n = len(order)
    kinds = []  # for each level: which of the sorted items are leaves
    items = leaf
    for _ in range(most - 1):
        kinds.append(None)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaf, pairs])
        at = np.argsort(merged, kind="stable")
        kinds[-1] = at < n
        items = merged[at]
    take = 2 * n - 2
    lengths = np.zeros(n, np.int64)
    for is_leaf in reversed(kinds):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[:take] += 1
    bits[order] = lengths
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """The code of each symbol: by length, then by symbol, counting up."""
    codes = np.zeros(len(bits), np.uint32)
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    if len(order):
        width = bits[order].astype(np.int64)
        step = np.uint64(1) << (MAX_BITS - width).astype(np.uint64)
        left = np.concatenate([[0], np.cumsum(step)[:-1]]).astype(np.uint64)
        codes[order] = (left >> (MAX_BITS - width).astype(np.uint64)).astype(np.uint32)
    return codes


def pack(ids: np.ndarray, bits: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids`` and the bit offset of every block of BLOCK_IDS ids."""
    width = bits[ids].astype(np.int64)
    end = np.cumsum(width)
    at = end - width
    total = int(end[-1]) if len(ids) else 0
    # each code lies in a 32-bit window that begins at its byte's 16-bit word
    word = at >> 4
    value = codes[ids].astype(np.uint64) << (32 - (at & 15) - width).astype(np.uint64)
    out = np.zeros((total + 15) // 16 + 2, np.uint64)
    if len(ids):
        run = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sums = np.add.reduceat(value, run)  # the windows of one word never overlap in their bits
        out[word[run]] += sums >> np.uint64(16)
        out[word[run] + 1] += sums & np.uint64(0xFFFF)
    return out.astype(">u2").tobytes(), at[::BLOCK_IDS]


def decode_table(bits: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and bits for each possible next 16 bits."""
    symbol, width = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.uint8)
    for s in np.flatnonzero(bits):
        low = int(codes[s]) << (MAX_BITS - int(bits[s]))
        symbol[low:low + (1 << (MAX_BITS - int(bits[s])))] = s
        width[low:low + (1 << (MAX_BITS - int(bits[s])))] = bits[s]
    return symbol, width


def unpack(data: bytes, checkpoints: np.ndarray, n: int, symbol: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The ids of a segment."""
    return unpack_all([data], [checkpoints], [n], symbol, width)


def unpack_all(data: list[bytes], checkpoints: list[np.ndarray], n: list[int], symbol: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The ids of several segments one after another; all their blocks are read side by side, each from its checkpoint."""
    words = np.frombuffer(b"".join(data), ">u2").astype(np.uint32)
    pairs = words[:-1] << 16 | words[1:]  # the 32 bits from each word on
    base = np.cumsum([0, *(len(x) * 8 for x in data[:-1])])
    at = np.concatenate([x + b for x, b in zip(checkpoints, base, strict=True)]).astype(np.int64)
    left = np.concatenate([np.minimum(BLOCK_IDS, m - np.arange(len(x)) * BLOCK_IDS) for x, m in zip(checkpoints, n, strict=True)]).astype(np.int64)
    order = np.argsort(-left, kind="stable")  # short blocks last: those that have ended are left out
    at = at[order]
    running = np.searchsorted(-left[order], -np.arange(BLOCK_IDS), "left")
    both = symbol.astype(np.uint32) | width.astype(np.uint32) << 16  # symbols are below 2**16
    out = np.zeros((BLOCK_IDS, len(order)), np.uint32)
    for k, m in enumerate(running.tolist()):
        if not m:
            break
        at = at[:m]
        entry = both[pairs[at >> 4] >> (16 - (at & 15)).astype(np.uint32) & 0xFFFF]
        out[k, :m] = entry
        at = at + (entry >> 16)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    out = out.T[back] & 0xFFFF
    return out[np.arange(BLOCK_IDS) < left[:, None]]


def counts_of(packed: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs; at most ``size`` rows come to the driver."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column("ids"):
                total += np.bincount(np.frombuffer(x.as_py(), "<u2"), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for r in packed.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def write(tokens: DataFrame, path: str, size: int, partitions: int, width: int = 4) -> None:
    """Write (id, ids) as a file of this format below ``path``: ``segments`` and ``codebook``. ``size``: ids are below it.

    ``width``: bytes of an id in ``tokens``. Without buckets the ids are saved before they are put in order, as finding
    the ranges reads them once more.
    """
    if size > 1 << 16:
        raise ValueError("ids must fit in 16 bits")
    spark = tokens.sparkSession
    narrow = tokens
    if "bucket" not in tokens.columns:
        tokens = tokens.select("id", "ids")
        narrow = saved(tokens if width == 2 else tokens.mapInArrow(_narrow, tokens.schema), "token-ids")
    packed = saved(segments(narrow, partitions), "id-segments")
    bits = code_lengths(counts_of(packed, size))
    # one row per partition: its number of ids, to place the partitions one after another
    sums = {r["part"]: r["n"] for r in packed.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
            .groupBy("part").agg(F.sum("n").alias("n")).collect()}
    base, at = {}, 0
    for part in sorted(sums):
        base[part] = at
        at += sums[part]
    book = spark.sparkContext.broadcast((bits, canonical_codes(bits), base))
    kind = packed.schema["doc_ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, codes, base = book.value
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                ids = np.frombuffer(one.column("ids")[0].as_py(), "<u2")
                data, marks = pack(ids, bits, codes)
                yield pa.RecordBatch.from_arrays([
                    pa.array([base[one.column("part")[0].as_py()] + one.column("start_in_part")[0].as_py()], pa.int64()),
                    one.column("doc_ids"), one.column("counts"), pa.array([len(ids)], pa.int64()),
                    pa.array([marks], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                    ["start", "doc_ids", "counts", "n_ids", "checkpoints", "payload"])

    (packed.mapInArrow(run, f"start long, doc_ids {kind}, counts array<int>, n_ids long, checkpoints array<long>, payload binary")
     .write.parquet(f"{path}/segments"))
    spark.createDataFrame([(int(i), int(bits[i])) for i in np.flatnonzero(bits)], "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")


def _narrow(batches):
    for b in batches:
        ids = pa.array([None if x is None else np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in b.column("ids").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("id"), ids], ["id", "ids"])


def read(spark, path: str) -> DataFrame:
    """(id, start, ids binary): little-endian uint32 ids of each document, read back from the file."""
    rows = spark.read.parquet(f"{path}/codebook").collect()  # one row per used id of the vocabulary
    bits = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint8)
    for r in rows:
        bits[r["id"]] = r["bits"]
    book = spark.sparkContext.broadcast(decode_table(bits, canonical_codes(bits)))
    files = spark.read.parquet(f"{path}/segments")
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, width = book.value
        for b in batches:
            sizes = np.asarray(b.column("n_ids"))
            cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // TOGETHER_IDS, prepend=-1, append=-1)).tolist()
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                some, n = b.slice(low, high - low), sizes[low:high].tolist()
                marks = [np.asarray(x.values) for x in some.column("checkpoints")]
                ids = unpack_all([x.as_py() for x in some.column("payload")], marks, n, symbol, width).astype("<u4")
                first = np.cumsum([0, *n])
                for i, name in enumerate(some.column("doc_ids")):
                    end = np.cumsum(np.asarray(some.column("counts")[i].values, np.int64))
                    begin = np.concatenate([[0], end[:-1]])
                    cuts = np.concatenate([[0], end * 4])
                    if cuts[-1] >= 1 << 31:  # one row of a batch cannot hold more; neither can a column of a JVM row
                        raise ValueError("a segment of 2 GB of ids")
                    own = np.ascontiguousarray(ids[first[i]:first[i + 1]])
                    lists = pa.Array.from_buffers(pa.binary(), len(end), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(own)])
                    yield pa.RecordBatch.from_arrays([name.values, pa.array(begin + some.column("start")[i].as_py()), lists], ["id", "start", "ids"])

    return files.mapInArrow(run, f"id {kind}, start long, ids binary")


def round_trip(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, pattern: str, lower: bool, end_id: int,
               size: int, partitions: int) -> DataFrame:
    """Encode ``docs`` to a new file in the shared folder and read it back."""
    path = scratch(docs.sparkSession, "token-file")
    numeric = isinstance(docs.schema[id_col].dataType, T.NumericType)
    edges = edges_of(docs.select(id_col), BUCKETS * partitions) if numeric else None
    write(tokenise(docs, id_col, text_col, tokenizer_json, pattern, lower, end_id, 2, edges), path, size, partitions, 2)
    return read(docs.sparkSession, path)

