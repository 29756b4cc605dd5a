"""Byte-level BPE encoding and decoding of whole texts (operator 1).

The tokenizers library encodes Arrow batches: a byte-level BPE is built from the rank file (each byte stands for
one printable character) and split by the vocabulary's own pattern. ``encode`` gives ids and, on demand, the
character range of each token; ``decode`` reverses the byte table, so that tokens that end inside a character come
back as the bytes they are and ``decoded`` equals the text's UTF-8 bytes exactly.

Nulls: a null text is an empty one (no ids, empty bytes). Other columns are not read. Each row is encoded by
itself, so repeated rows give repeated results, and an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, ragged, release, slices, text_buffer
from .tokenizing import byte_level_json, read_ranks, worker_encoder


class ByteTable:
    """Bytes of every token id, as one flat array."""

    def __init__(self, ranks: dict[bytes, int]):
        top = max(ranks.values(), default=-1) + 1
        token = [b""] * top
        for t, r in ranks.items():
            token[r] = t
        self.lengths = np.fromiter(map(len, token), np.int64, top)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(token), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.starts[ids], self.lengths[ids])


def character_ranges(buf: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens of ``lengths`` bytes each: the characters of their text that they touch, as [start, end).

    Two tokens that share a split character both hold it. ``first`` are the n+1 token offsets of the texts.
    """
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # characters begun before each byte
    end = np.cumsum(lengths)
    base = np.repeat(lead[offsets[:-1]], np.diff(first))
    return lead[end - lengths + 1] - 1 - base, lead[end] - base


def encode(docs: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """(id, ids array<int>), with char_start and char_end (array<int>) per token if ``offsets``."""
    prepare(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks = read_ranks(f.read())
    # a public vocabulary of fixed size, about 1.5 MB
    shared = docs.sparkSession.sparkContext.broadcast((byte_level_json(ranks, pattern), ranks if offsets else None))
    more = ", char_start array<int>, char_end array<int>" if offsets else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        js, own = shared.value
        encoder = worker_encoder(js, pattern, False)
        table = ByteTable(own) if own is not None else None
        for b in slices(batches, "text"):
            ids, first = encoder.encode(b.column("text"))
            out = [b.column("id"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))]
            names = ["id", "ids"]
            if table is not None:
                buf, at = text_buffer(b.column("text"))
                for name, x in zip(("char_start", "char_end"), character_ranges(buf, at, table.lengths[ids], first), strict=True):
                    out.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x.astype(np.int32))))
                    names.append(name)
            yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>{more}")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(id, ids, decoded binary) of (id, ids); ids outside the vocabulary fail the job."""
    prepare(encoded.sparkSession)
    with open(ranks_path, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(ByteTable(read_ranks(f.read())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                lists = b.column("ids")
                ids = np.asarray(lists.flatten())
                n = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
                data = table.bytes_of(ids)
                size = np.concatenate([[0], np.cumsum(table.lengths[ids])])[np.concatenate([[0], np.cumsum(n)])]
                texts = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([b.column("id"), lists, texts.cast(pa.binary())], ["id", "ids", "decoded"])
        release()

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
