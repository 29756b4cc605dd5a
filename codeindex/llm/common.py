"""Shared helpers of the llm operators: table access, shared folder, text slices, hashing, grouped maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import BATCH_ROWS, release, shared_dir, ship_package, swept  # noqa: F401

U64 = np.uint64
_R = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_R_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)

# A slice of text handled at once in a worker. Every array below is a small multiple of it.
SLICE_BYTES = 2 << 20


def prepare(spark: SparkSession) -> None:
    """What every operator needs before it sends rows to workers: the package there, and bounded batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder (spark.checkpoint.dir)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def deleted(*tables: DataFrame) -> None:
    """Delete the files of tables from ``saved`` that nothing reads any more; an empty one may stay."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            p = spark._jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (Steele et al., 2014) on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """An independent hash of ``x`` for each seed."""
    return mix(x + U64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64)))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """1, R, R**2, ... modulo 2**64 (or of the inverse of R)."""
    return _powers(_R_INV if inverse else _R, n)


class Rolling:
    """Polynomial hashes of any byte range of a buffer, from one prefix sum modulo 2**64."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.inverse = None
        self.prefix = np.zeros(n + 1, np.uint64)
        terms = _powers(_R, n)
        terms *= _BYTE[buf]
        np.cumsum(terms, out=self.prefix[1:])

    def _inverse(self) -> np.ndarray:
        if self.inverse is None:
            self.inverse = _powers(_R_INV, len(self.prefix))
        return self.inverse

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed 64-bit hash of buf[start:end] for each pair; the length takes part."""
        return mix((self.prefix[end] - self.prefix[start]) * self._inverse()[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The same hash for the window of ``width`` bytes at each position."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.prefix[width:] - self.prefix[:n]) * self._inverse()[:n] + U64(width))


def distinct(buf: np.ndarray, cuts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different strings (compared byte by byte) among buf[cuts[i]:cuts[i+1]], and which of them each one is."""
    data = np.ascontiguousarray(buf)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
    found = pieces.dictionary_encode()
    return found.dictionary, np.asarray(found.indices)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lengths[i]] of all i, one after another."""
    total = np.cumsum(lengths)
    at = np.repeat(starts - (total - lengths), lengths)
    at += np.arange(len(at))
    return flat[at]


class Known:
    """Slots 0, 1, ... of the byte strings added so far: found in bulk by a 64-bit hash, then compared byte by byte."""

    def __init__(self):
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted hashes, and the slot of each
        self.arena, self.at = np.empty(1 << 16, np.uint8), np.zeros(1, np.int64)  # their bytes, and n+1 offsets

    def __len__(self) -> int:
        return len(self.at) - 1

    @property
    def held(self) -> int:
        return int(self.at[-1])

    def find(self, names: pa.Array) -> np.ndarray:
        """The slot of each name, -1 for one that is not known."""
        out = np.full(len(names), -1)
        if not len(self) or not len(names):
            return out
        data, off = binary_buffer(names)
        hashes = Rolling(data).ranges(off[:-1], off[1:])
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        slot, size = self.slots[place], np.diff(off)
        hit = np.flatnonzero((self.keys[place] == hashes) & (self.at[slot + 1] - self.at[slot] == size))
        slot, size = slot[hit], size[hit]
        differs = ragged(data, off[:-1][hit], size) != ragged(self.arena, self.at[slot], size)
        wrong = np.concatenate([[0], np.cumsum(differs)])[np.concatenate([[0], np.cumsum(size)])]
        same = wrong[1:] == wrong[:-1]
        out[hit[same]] = slot[same]
        return out

    def add(self, names: pa.Array) -> np.ndarray:
        """Which of the names (all different and unknown) were added, as the next slots; a name whose hash is taken is not."""
        data, off = binary_buffer(names)
        hashes, first = np.unique(Rolling(data).ranges(off[:-1], off[1:]), return_index=True)
        place = np.searchsorted(self.keys, hashes)
        free = self.keys[np.minimum(place, len(self.keys) - 1)] != hashes if len(self.keys) else np.ones(len(hashes), bool)
        place, hashes, first = place[free], hashes[free], first[free]
        order = np.argsort(first)
        slot = np.empty(len(first), np.int64)
        slot[order] = len(self) + np.arange(len(first))
        added = first[order]
        size = np.diff(off)[added]
        used, need = self.held, self.held + int(size.sum())
        if need > len(self.arena):
            self.arena = np.concatenate([self.arena, np.empty(max(need, len(self.arena) // 2), np.uint8)])
        self.arena[used:need] = ragged(data, off[:-1][added], size)
        self.at = np.concatenate([self.at, used + np.cumsum(size)])
        self.keys, self.slots = np.insert(self.keys, place, hashes), np.insert(self.slots, place, slot)
        return added


def binary_buffer(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large string or binary array without nulls, and the n+1 offsets of its rows."""
    _, off, data = names.buffers()
    n = len(names)
    offsets = np.frombuffer(off, np.int64, count=n + 1 + names.offset)[names.offset:] if off is not None else np.zeros(n + 1, np.int64)
    if n == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8)[first:last], offsets - first


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array (null: empty) and the n+1 offsets of its rows."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return binary_buffer(texts)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``; one longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0), dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    release()


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of ASCII letters, digits and non-ASCII bytes) of each row.

    Returns byte starts, byte ends, and for each row the index of its first word (n+1 entries).
    """
    n = len(buf)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _WORD[buf]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of each row, and each row's first word index (n+1 entries)."""
    buf, offsets = text_buffer(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    starts, ends, first = word_spans(buf, offsets)
    out = np.empty(len(starts), np.uint64)
    for a, b in row_slices(offsets):
        low, (i, j) = int(offsets[a]), first[[a, b]]
        out[i:j] = Rolling(buf[low:int(offsets[b])]).ranges(starts[i:j] - low, ends[i:j] - low)
    return out, first


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; one longer row is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
        yield at, to
        at = to


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words; a row of fewer (but some) words has one shingle, all its words."""
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    start = first[:-1][row] + (np.arange(out_first[-1]) - out_first[:-1][row])
    have = np.minimum(width, count)[row]
    h = np.zeros(len(start), np.uint64)
    top = max(0, len(words) - 1)
    for k in range(width):
        part = words[np.minimum(start + k, top)] * U64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) if len(words) else h
        h += np.where(k < have, part, U64(0))
    return mix(h + have.astype(np.uint64)), out_first


def grouped(keys: list[str], fn: Callable[[pa.Table], Iterable[pa.RecordBatch] | pa.RecordBatch | None]):
    """For mapInArrow over a frame sorted by ``keys`` in each partition: call ``fn`` with each group's table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush():
            if held:
                out = fn(pa.Table.from_batches(held))
                held.clear()
                if out is not None:
                    yield from [out] if isinstance(out, pa.RecordBatch) else out

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            change = np.zeros(n, bool)
            for k in keys:
                col = np.asarray(batch.column(batch.schema.get_field_index(k)))
                change[1:] |= col[1:] != col[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), n]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(batch.column(batch.schema.get_field_index(k))[a].as_py() for k in keys)
                if key != last:
                    yield from flush()
                    last = key
                held.append(batch.slice(a, b - a))
        yield from flush()
        release()

    return run


def by_groups(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Deal ``df`` out by ``keys`` and run ``fn`` on each group (groups must be bounded by the caller)."""
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(grouped(keys, fn), schema)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)
