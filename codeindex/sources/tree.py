"""Tree listings and blobs (S05, S06, F07, J02): the per-file route for large repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import columns as C
from ..functions.languages import with_language


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """One recursive listing per repository -> one row per entry; ``truncated`` is kept.

    Listings lie in folders by repository, so a join on repository_id reads those of its repositories only.
    """
    raw = spark.read.schema(schemas.TREE).json(path)
    return raw.select("repository_id", "truncated", F.inline("tree"))


def source_items(items: DataFrame) -> DataFrame:
    """F07 + F03 + F04: blobs with a supported, non-hidden path, with their language."""
    blobs = items.where((F.col("type") == "blob") & ~C.is_hidden(F.col("path")))
    return with_language(blobs, "path", "language", how="inner")


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Blob payloads as landed, in folders by repository: (repository_id, url, encoding, content)."""
    raw = spark.read.schema(T.StructType([*schemas.BLOB.fields, T.StructField("repository_id", T.LongType())])).json(path)
    return raw.select("repository_id", *schemas.BLOB.fieldNames())


def decode_blobs(blobs: DataFrame) -> DataFrame:
    """S06 + F05: base64 (line breaks allowed) -> bytes -> UTF-8 text; bad base64 and invalid UTF-8 are flagged."""
    raw = F.try_to_binary(F.regexp_replace("content", r"\s", ""), F.lit("base64"))
    utf8 = C.is_valid_utf8_bytes(raw)
    own = ["repository_id"] if "repository_id" in blobs.columns else []
    return blobs.select(*own, "url", F.octet_length(raw).alias("size"), raw.isNotNull().alias("base64"), F.coalesce(utf8, F.lit(False)).alias("utf8"),
                        F.when(utf8, raw.cast("string")).alias("text"))


def join_blobs(items: DataFrame, blobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listing entries ⋈ decoded blobs by url -> (files, rejects).

    Both sides are keyed by url (and repository, where the blobs carry it), so this is a plain shuffle (or broadcast, when
    AQE sees a small side) equi-join; rejects are missing blobs and non-UTF-8 blobs.
    """
    dec = decode_blobs(blobs)
    j = items.join(dec, [c for c in ("repository_id", "url") if c in dec.columns], "left")
    files = j.where(F.col("utf8")).select(
        "repository_id", F.col("path").alias("file_path"), F.col("text").alias("content"), "language", "size",
        "url")
    bad = j.where(~F.coalesce(F.col("utf8"), F.lit(False))).select(
        F.lit("blob_fetch").alias("stage"), F.col("url").alias("key"),
        F.when(F.col("utf8").isNull(), F.lit("blob not found")).when(~F.col("base64"), F.lit("not base64"))
         .otherwise(F.lit("not utf-8")).alias("reason"))
    return files, bad


# ---- fixture landing (test scaffolding) -----------------------------------------

def trees_payload(fx_tree_items: DataFrame) -> DataFrame:
    item = F.from_json("item_json", schemas.TREE_ITEM)
    return fx_tree_items.groupBy("repository_id").agg(
        F.lit(False).alias("truncated"), F.collect_list(item).alias("tree"))


def blobs_payload(fx_tree_items: DataFrame) -> DataFrame:
    b64 = F.base64(F.encode(F.col("blob_text"), "UTF-8"))
    wrapped = (F.when(F.col("fault") == "base64", F.lit("*not base64*")).when(F.col("fault") == "utf8", F.lit("//4="))
                .otherwise(F.regexp_replace(b64, "(.{60})", "$1\n")))
    return fx_tree_items.where(F.col("blob_text").isNotNull()).select(
        "repository_id", "url", F.lit("base64").alias("encoding"), wrapped.alias("content"))
