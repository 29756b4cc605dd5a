"""Chunk rows -> code documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import chunking


def code_documents(files_with_requests: DataFrame, **chunk_kw) -> DataFrame:
    """Files (with owner / repo_name / branch) -> one code document per chunk."""
    chunks = chunking.chunk_records(files_with_requests, **chunk_kw)
    return chunks.select(
        C.code_doc_id(F.col("repository_id"), F.col("file_path"), F.col("chunk_index")).alias("id"),
        F.lit(0).alias("sourceType"),
        "file_path",
        F.lit("CODE").alias("category"),
        C.source_label(F.col("repo_name"), F.col("branch")).alias("source"),
        F.col("chunk_text").alias("text"),
        "repository_id",
        "owner",
        F.coalesce(F.col("language"), F.lit("text")).alias("language"),
        C.blob_url(F.col("owner"), F.col("repo_name"), F.col("branch"), F.col("file_path")).alias("html_url"),
        "metadata",
        C.index_name(F.col("repo_name"), F.col("branch"), "_code").alias("index_name"),
        "chunk_index",
        "class_name",
        "function_name",
        "route",
        "chunk_error",
    )
