"""One registered query per operator: each runs over its whole table and derives digest columns from real outputs."""

from __future__ import annotations

import json
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    chosen_path,
    compact_windows,
    decontaminate,
    hard_negatives,
    huffman_ids,
    langid,
    merkle_audit,
    pivot_index,
    sharding,
    suffix_dedup,
    token_counts,
)
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern(tokenizer_json: str) -> str:
    """The split pattern that a tokenizer file states itself."""
    steps = json.loads(tokenizer_json)["pre_tokenizer"]
    return next(s["pattern"]["Regex"] for s in steps.get("pretokenizers", [steps]) if s["type"] == "Split")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (token_counts.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("piece_bpe_32k.model"))
            .withColumnRenamed("id", "doc_id"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang")
    return langid.predict(docs, "doc_id", "text", model).select(
        F.col("id").alias("doc_id"), langid.held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def replica_of(pages: DataFrame) -> DataFrame:
    """A second replica with damage by rule: some bodies changed in one place, some records lost."""
    code = F.crc32(F.col("page_id").cast("string").cast("binary"))
    body = F.when(code % 61 == 7, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    return pages.where(code % 97 != 5).select("page_id", "url", body.alias("html"))


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    own, other = (merkle_audit.warc_records(x, "page_id", "url", "html") for x in (pages, replica_of(pages)))
    return merkle_audit.audit(own, other).select(F.col("id").alias("page_id"), "file", "start", "size", "status", "hash", "replica_hash")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.contaminated(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
            .select(F.col("id").alias("doc_id"), "item_id", "start_word", "n_words", "share"))


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similarity_classes(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def op8_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_index.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compact_windows.passages(table(spark, sf_dir, "documents"), "doc_id", "text")
    return (found.select(F.col("id").alias("doc_id"), F.explode("repeats").alias("r"))
            .select("doc_id", F.col("r.holder").alias("first_doc_id"), F.col("r.start").alias("start_byte"), F.col("r.end").alias("end_byte"),
                    F.col("r.words").alias("n_words"), F.col("r.jaccard").alias("jaccard")))


def _digests(batches):
    for b in batches:
        ids = b.column("ids").to_pylist()
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("start"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                          pa.array([zlib.crc32(x) for x in ids], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        js = f.read()
    size = max(json.loads(js)["model"]["vocab"].values()) + 1
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = huffman_ids.round_trip(docs, "doc_id", "text", js, split_pattern(js), True, 1, size, partitions)
    kind = back.schema["id"].dataType.simpleString()
    return back.mapInArrow(_digests, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        js = f.read()
    with open(vocabulary("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    found, _ = alignment.align(table(spark, sf_dir, "documents"), "doc_id", "text", js, public_tokenizers.PATTERN, model)
    return found.withColumnRenamed("id", "doc_id").drop("groups")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(rows.withColumn("label", label), "vec_id", "embedding", "label", F.col("id") % 100 == 0)
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
                        "positive_score", "negative_score")


def op13_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_token_counts, op3_language_id, op4_suffix_dedup, op5_merkle_audit, op6_spaced_seeds,
                                   op7_chosen_path, op8_pivot_index, op9_compact_windows, op10_huffman_ids, op11_alignment, op12_hard_negatives, op13_feistel_shards, pipeline)}

ORACLE = {
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM d, unnest(range(greatest(0, length(h) // 2 - 49))) AS t(i)),
m AS (SELECT s, min(doc_id) AS f FROM w GROUP BY s),
hit AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, unnest(range(50)) AS t(k)),
spans AS (SELECT doc_id, count(*) AS n_spans FROM (
            SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM gone) WHERE q IS NULL OR q < p - 1 GROUP BY doc_id),
bytes AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x FROM d, unnest(range(length(h) // 2)) AS t(p)),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY p) AS k, count(*) AS n FROM bytes ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(length(h) // 2 - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(from_hex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)""",
    "op7_chosen_path": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(2, len(ws) - 3))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE c >= 0.8 * (na.n + nb.n - c) - 1e-9),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, min(r.b) AS class_id, (SELECT count(*) FROM link WHERE link.a = d.doc_id) AS n_links
FROM documents d JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
    "op13_feistel_shards": f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda t: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, t)) AS crc),
d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h, row_number() OVER (ORDER BY doc_id NULLS FIRST, sha256(coalesce(text, '')), text IS NULL) - 1 AS k FROM documents),
c AS (SELECT k, list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
                            lambda c, x: xor(c // 256, crc[CAST(xor(c, x) % 256 + 1 AS INT)]), CAST(4294967295 AS BIGINT)) AS crc FROM d, tab),
m AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM d)),
f AS (SELECT k, k % a AS l, k // a AS r, 0 AS i FROM d, m UNION ALL
      SELECT k, CASE WHEN i % 2 = 0 THEN (l + x) % a ELSE l END, CASE WHEN i % 2 = 1 THEN (r + x) % b ELSE r END, i + 1
      FROM (SELECT f.*, CAST('0x' || substr(md5('{sharding.SEED}:' || (i % {sharding.ROUNDS}) || ':' || CASE WHEN i % 2 = 0 THEN r ELSE l END), 1, 15) AS BIGINT) AS x FROM f), m
      WHERE i = 0 OR i % {sharding.ROUNDS} > 0 OR l + r * a >= n),
p AS (SELECT k, l + r * a AS p FROM f, m WHERE i > 0 AND i % {sharding.ROUNDS} = 0 AND l + r * a < n)
SELECT doc_id, CAST(length(h) // 2 + 1 AS BIGINT) AS size, CAST(xor(crc, 4294967295) AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(p % {sharding.SHARDS} AS INT) AS shard, CAST(p // {sharding.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM d JOIN c USING (k) JOIN p USING (k)""",
    "op8_pivot_index": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c ON c.a = v.vec_id""",
}
