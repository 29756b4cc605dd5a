"""File -> chunk rows.

Routing is decided natively per file: blank files produce nothing, Java files
passing the gate are cut per method, files under 500 characters stay whole and
everything else goes through the size-bounded splitter. Only the Java and split
routes cross into Python, in Arrow batches; the whole-file route never leaves the
JVM. Names, metadata, headers and ids are native expressions on the exploded rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..session import bounded_batches, release, ship_package
from . import java_methods, splitter

ROUTE_SKIP, ROUTE_JAVA, ROUTE_WHOLE, ROUTE_SPLIT = "skip", "java", "whole", "split"

PIECES = T.StructType([
    T.StructField("pieces", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])


def route(content: Column, language: Column, chunk_size: Column) -> Column:
    return (F.when(C.is_blank(content), F.lit(ROUTE_SKIP))
             .when(C.java_gate(content, language), F.lit(ROUTE_JAVA))
             .when(chunk_size.isNull(), F.lit(ROUTE_WHOLE))
             .otherwise(F.lit(ROUTE_SPLIT)))


def pieces_for(text: str, language: str | None, route_name: str, size: int | None,
               keep_tail: bool = False) -> list[str]:
    """Raw chunk texts for one file on the Java or split route."""
    if route_name == ROUTE_JAVA:
        got = java_methods.java_method_chunks(text, keep_tail)
        return got if len(got) > 1 else [text]
    got = splitter.split_text(text, int(size), splitter.separators_for(language))
    if len(got) == 1 and len(got[0]) < size * 1.2:
        return [text]
    return got


# Characters of text that a worker cuts before it hands their pieces back.
SLICE_CHARS = 4 << 20


def _slices(n: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_CHARS characters each."""
    start, held = 0, 0
    for i, size in enumerate(n):
        if held and held + size > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += size
    yield start, len(n)


def _pieces_udf(keep_tail: bool):
    @F.arrow_udf(PIECES)
    def cut(content: pa.Array, language: pa.Array, route_name: pa.Array, size: pa.Array) -> pa.Array:
        kind = pa.struct([("pieces", pa.list_(pa.string())), ("error", pa.string())])
        parts = []
        lengths = pc.fill_null(pc.utf8_length(content), 0).to_pylist()
        for start, end in _slices(lengths):
            rows = []
            for text, lang, r, n in zip(*(x.slice(start, end - start).to_pylist() for x in (content, language, route_name, size)), strict=True):
                if text is None:
                    rows.append({"pieces": None, "error": None})
                    continue
                try:
                    rows.append({"pieces": pieces_for(text, lang, r, n, keep_tail), "error": None})
                except Exception as exc:  # one bad file becomes one whole chunk, the job goes on
                    rows.append({"pieces": [text], "error": f"{type(exc).__name__}: {exc}"})
            parts.append(pa.array(rows, kind))
            del rows
        out = pa.concat_arrays(parts)
        release()
        return out
    return cut


def with_route(files: DataFrame, content: str = "content", language: str = "language",
               dynamic: bool = True, static_size: int = 1500) -> DataFrame:
    size = C.size_class_chunk(F.col(content), dynamic, static_size)
    return (files.withColumn("chunk_size", size)
                 .withColumn("route", route(F.col(content), F.col(language), F.col("chunk_size"))))


def chunk_files(files: DataFrame, content: str = "content", language: str = "language",
                dynamic: bool = True, static_size: int = 1500, keep_tail: bool = False,
                rebalance: bool = True) -> DataFrame:
    """One row per chunk: input columns + route, chunk_index, chunk_raw, chunk_error.

    ``rebalance`` spreads files over tasks before the Python step (AQE splits
    skewed partitions of a REBALANCE and merges small ones), since a single
    repository or archive can hold a large share of all files.
    """
    ship_package(files.sparkSession)
    bounded_batches(files.sparkSession)
    routed = with_route(files, content, language, dynamic, static_size).where(F.col("route") != ROUTE_SKIP)
    if rebalance:
        routed = routed.hint("rebalance")
    needs_python = F.col("route").isin(ROUTE_JAVA, ROUTE_SPLIT)
    cut = _pieces_udf(keep_tail)(F.when(needs_python, F.col(content)), F.col(language), F.col("route"),
                                 F.col("chunk_size"))
    with_pieces = routed.withColumn("_cut", cut)
    pieces = F.when(needs_python, F.col("_cut.pieces")).otherwise(F.array(F.col(content)))
    return (with_pieces
            .select("*", F.posexplode(pieces).alias("chunk_index", "chunk_raw"))
            .withColumn("chunk_error", F.when(needs_python, F.col("_cut.error")))
            .drop("_cut"))


def with_names(chunks: DataFrame, text: str = "chunk_raw", language: str = "language") -> DataFrame:
    """class_name / function_name from the chunk's own text, plus the metadata map."""
    return (chunks.withColumn("class_name", C.extract_class(F.col(text), F.col(language)))
                  .withColumn("function_name", C.extract_function(F.col(text), F.col(language)))
                  .withColumn("metadata", C.name_metadata(F.col("class_name"), F.col("function_name"))))


def chunk_records(files: DataFrame, repo_col: str = "repository_id", path_col: str = "file_path",
                  **kw) -> DataFrame:
    """CodeChunk rows: chunk_id, file_path, content (with header), language, metadata."""
    chunks = with_names(chunk_files(files, **kw))
    return (chunks
            .withColumn("chunk_id", C.chunk_id(F.col(repo_col), F.col(path_col), F.col("chunk_index")))
            .withColumn("chunk_text", C.chunk_header(F.col(path_col), F.col("chunk_raw"))))
