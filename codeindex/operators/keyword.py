"""Keyword index (Q01, Q02): attribute postings laid out for top-k search with score bounds.

``KeywordIndex.build`` tokenises the searchable attributes of documents once and writes below its root

* ``postings``: one row per (token, document) with the count in each attribute, the document's length and ``ratio``, the
  part of the BM25 score that does not depend on the query. Rows lie in folders by ``bucket`` (a hash of the token) and
  ``tier`` (a quarter of the range of ratios), so a folder bounds the ratio of everything in it;
* ``terms``: per token the number of its documents and its largest ratios, in folders by bucket;
* ``meta``: document count, mean length, attribute names.

``search`` is exact. A query's k-th best score is at least the k-th best part of any one of its tokens, which ``terms``
tells. Below that floor nothing counts, so a token's posting is left out if even the best parts of all other tokens leave
it below the floor of every query that asks for the token: its tier's folder is then not read (dynamic partition pruning
on bucket and tier).

Queries never meet postings as rows. Postings of the asked tokens are read once and dealt out by blocks of documents
(about ``BLOCK_TOKENS`` tokens each); a block meets the queries in groups of ``QUERY_ROWS``, adds up the scores of a query
in one array over its documents and hands on its k best that reach the floor. Where there are many blocks, the first few
(the square root of their number) raise the floors of the others.

Equal scores go to the document that matches in the earlier attribute, then to the smaller key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_path, release, ship_package
from .embed import tokens

K1, B = 1.2, 0.75
TIERS = 4
DEEPEST = 100  # a token's largest ratios that ``terms`` keeps; a search for more has no floor
BUCKET_BYTES = 64 << 20
TASK_BYTES = 4 << 20
BUCKETS = (16, 1024)  # fewest and most folders of tokens
ROUNDING = 1.1e-6  # scores are compared after rounding to 6 decimals
BLOCK_TOKENS, BLOCK_DOCS = 4 << 20, 1 << 14  # at most about so many tokens and documents in a block
QUERY_ROWS = 1 << 14  # queries that meet a block at once
MANY_BLOCKS = 16  # from here on, some blocks go first


def attribute_text(docs: DataFrame, c: Column, name: str) -> Column:
    """The text of an attribute; of an array, one value per line."""
    return F.array_join(c, "\n") if dict(docs.dtypes).get(name, "").startswith("array") else c


def _tagged(rank: int):
    return lambda t: F.struct(F.lit(rank).alias("a"), t.alias("t"))


def token_counts(docs: DataFrame, key: str, attributes: list[Column]) -> DataFrame:
    """(key, dl, token, tf_0, tf_1, ...): how often each attribute holds the token; dl: tokens of the document.

    Documents are dealt out by key before they are tokenised (one shuffle of the text, which is smaller than its
    tokens), whatever the layout of the input; the counting then needs no further shuffle.
    """
    texts = docs.select(F.col(key), *[a.alias(f"_a{i}") for i, a in enumerate(attributes)])
    size = texts.agg(sum((F.coalesce(F.sum(F.octet_length(f"_a{i}")), F.lit(0)) for i in range(len(attributes))), F.lit(0))).first()[0]
    # a task counts the tokens of about TASK_BYTES of text, however large the table is
    spread = texts.repartition(max(-(-size // TASK_BYTES), docs.sparkSession.sparkContext.defaultParallelism), key)
    lists = spread.select(key, *[F.coalesce(tokens(F.col(f"_a{i}")), F.array().cast("array<string>")).alias(f"_a{i}") for i in range(len(attributes))])
    sized = lists.withColumn("dl", sum(F.size(f"_a{i}") for i in range(len(attributes))))
    tagged = F.flatten(F.array(*[F.transform(f"_a{i}", _tagged(i)) for i in range(len(attributes))]))
    each = sized.select(key, "dl", F.explode(tagged).alias("x")).select(key, "dl", F.col("x.t").alias("token"), F.col("x.a").alias("a"))
    return each.groupBy(key, "dl", "token").agg(*[F.count(F.when(F.col("a") == i, 1)).alias(f"tf_{i}") for i in range(len(attributes))])


def postings(docs: DataFrame, key: str, attributes: dict[str, Column]) -> DataFrame:
    """Q01: (attribute, token, key, tf, dl), one row per attribute that holds the token."""
    counts = token_counts(docs, key, list(attributes.values()))
    each = F.array(*[F.struct(F.lit(name).alias("attribute"), F.col(f"tf_{i}").alias("tf")) for i, name in enumerate(attributes)])
    rows = counts.select(key, "token", "dl", F.explode(F.filter(each, lambda x: x["tf"] > 0)).alias("x"))
    return rows.select("x.attribute", "token", key, "x.tf", "dl")


def idf(n_docs: int) -> Column:
    return F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))


def _bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _held(df: DataFrame, name: str) -> DataFrame:
    """Written below the shared folder: its size is then known to the planner, and it is computed once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class PostingBlock:
    """The postings of a block's documents in memory: ``keys`` ascending (null first), and postings by token."""

    def __init__(self, rows: pa.Table, key: str):
        found = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode")
        order = np.asarray(pc.sort_indices(found.dictionary, null_placement="at_start")).astype(np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.of_row = found.dictionary.take(pa.array(order)), place[np.asarray(found.indices)]
        held = np.asarray(pc.is_valid(rows.column("token_id")))
        token, doc = np.asarray(rows.column("token_id").drop_null()), self.of_row[held]
        ratio, attribute = np.asarray(rows.column("ratio").drop_null()), np.asarray(rows.column("attribute").drop_null())
        order = np.lexsort((doc, token))
        token, doc = token[order], doc[order]
        # rows that share a key are one document
        head = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])])) if len(token) else np.empty(0, np.int64)
        self.doc = doc[head]
        self.ratio = np.add.reduceat(ratio[order], head) if len(head) else np.empty(0)
        self.attribute = np.minimum.reduceat(attribute[order], head) if len(head) else np.empty(0, np.int32)
        self.tokens, first = np.unique(token[head], return_index=True)
        self.ends = np.append(first, len(head))

    def parts(self, tokens: np.ndarray, idf: np.ndarray) -> list[tuple[int, int, float]]:
        """(first, end, idf) of the postings of those ``tokens`` that the block holds."""
        at = np.searchsorted(self.tokens, tokens)
        ok = at < len(self.tokens)
        ok[ok] = self.tokens[at[ok]] == tokens[ok]
        return list(zip(self.ends[at[ok]].tolist(), self.ends[at[ok] + 1].tolist(), idf[ok].tolist(), strict=True))

    def scores(self, parts: list[tuple[int, int, float]]) -> np.ndarray:
        out = np.zeros(len(self.keys))
        for a, z, idf in parts:
            out[self.doc[a:z]] += idf * self.ratio[a:z]
        return out

    def attributes(self, parts: list[tuple[int, int, float]]) -> np.ndarray:
        out = np.full(len(self.keys), np.iinfo(np.int32).max, np.int32)
        for a, z, _ in parts:
            own = self.doc[a:z]
            out[own] = np.minimum(out[own], self.attribute[a:z])
        return out


def each_query(asked: pa.Table):
    """(tokens, idf) of every query, in ascending order of the tokens."""
    for own in asked.column("terms").to_pylist():
        own = sorted((x["token_id"], x["idf"]) for x in own or ())
        yield np.array([x[0] for x in own], np.int64), np.array([x[1] for x in own], np.float64)


def largest(scores: np.ndarray, k: int, slack: float = 0.0) -> np.ndarray:
    """Places of the ``k`` largest scores, and of all that are equal to the last of them or less by ``slack`` at most."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - slack)


def best_documents(query: str, key: str, k: int | None):
    """The documents of a block that reach the floor of each query of a group, the ``k`` best of them."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        of, at, score, attribute = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int32)]
        block = PostingBlock(rows, key)
        ranked = bool(block.attribute.any())
        for j, ((tokens, idf), floor) in enumerate(zip(each_query(asked), asked.column("floor").to_pylist(), strict=True)):
            parts = block.parts(tokens, idf)
            if not parts:
                continue
            s = block.scores(parts)
            some = np.flatnonzero((s > 0) & (s >= floor))
            if k is not None:
                some = some[largest(s[some], k, ROUNDING)]
            rank = block.attributes(parts)[some] if ranked else np.zeros(len(some), np.int32)
            s = np.round(s[some], 6)
            best = np.lexsort((some, rank, -s))[:k]
            of.append(np.full(len(best), j))
            at.append(some[best])
            score.append(s[best])
            attribute.append(rank[best])
        out = pa.table({query: asked.column(query).take(pa.array(np.concatenate(of))), key: block.keys.take(pa.array(np.concatenate(at))),
                        "score": pa.array(np.concatenate(score)), "attribute": pa.array(np.concatenate(attribute))})
        del block
        release()
        return out

    return run


@dataclass
class KeywordIndex:
    spark: SparkSession
    root: str
    key: str
    attributes: list[str]
    n_docs: int
    avgdl: float
    buckets: int

    @classmethod
    def build(cls, docs: DataFrame, key: str, attributes: dict[str, Column], root: str | None = None) -> KeywordIndex:
        """Index ``docs`` by the texts of ``attributes``, given in rank order."""
        spark = docs.sparkSession
        root = root or new_path(spark, "keyword-index")
        # the documents may be long in the making, and are read three times
        docs.select(F.col(key), *[a.alias(f"_text{i}") for i, a in enumerate(attributes.values())]).write.parquet(f"{root}/texts")
        docs = spark.read.parquet(f"{root}/texts")
        token_counts(docs, key, [F.col(f"_text{i}") for i in range(len(attributes))]).write.parquet(f"{root}/counts")
        counts = spark.read.parquet(f"{root}/counts")
        tfs = [F.col(f"tf_{i}") for i in range(len(attributes))]
        counts = counts.withColumn("tf", sum(tfs[1:], tfs[0]))
        n_docs = docs.select(key).count()
        total = counts.agg(F.coalesce(F.sum("tf"), F.lit(0))).first()[0]
        avgdl = total / n_docs if total else 1.0
        buckets = min(BUCKETS[1], max(BUCKETS[0], -(-_bytes(spark, f"{root}/counts") // BUCKET_BYTES)))
        ratio = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
        first = F.coalesce(*[F.when(t > 0, i) for i, t in enumerate(tfs)])
        rows = (counts.withColumn("ratio", ratio).withColumn("attribute", first).withColumn("bucket", bucket_of("token", buckets))
                .withColumn("tier", F.least(F.lit(TIERS - 1), F.floor(F.col("ratio") * TIERS / (K1 + 1))).cast("int")))
        # a rebalance splits the folders of hot tokens over tasks
        rows.hint("rebalance", "bucket", "tier").sortWithinPartitions("bucket", "tier", "token").write.partitionBy("bucket", "tier").parquet(f"{root}/postings")
        best = Window.partitionBy("token").orderBy(F.desc("ratio"))
        top = (rows.select("token", "ratio").withColumn("n", F.row_number().over(best)).where(F.col("n") <= DEEPEST)
               .groupBy("token").agg(F.sort_array(F.collect_list("ratio"), asc=False).alias("top")))
        df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        terms = df.join(top, "token").withColumn("bucket", bucket_of("token", buckets))
        terms.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{root}/terms")
        spark.createDataFrame([(key, list(attributes), n_docs, float(avgdl), buckets)],
                              "key string, attributes array<string>, n_docs long, avgdl double, buckets int").coalesce(1).write.parquet(f"{root}/meta")
        return cls(spark, root, key, list(attributes), n_docs, float(avgdl), buckets)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> KeywordIndex:
        m = spark.read.parquet(f"{root}/meta").first()
        return cls(spark, root, m["key"], list(m["attributes"]), m["n_docs"], m["avgdl"], m["buckets"])

    def postings(self) -> DataFrame:
        return self.spark.read.schema(self._schema("postings")).parquet(f"{self.root}/postings")

    def terms(self) -> DataFrame:
        return self.spark.read.schema(self._schema("terms")).parquet(f"{self.root}/terms")

    def _schema(self, name: str) -> str:
        if name == "terms":
            return "token string, df long, top array<double>, bucket int"
        counts = self.spark.read.parquet(f"{self.root}/counts").schema
        own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts)
        return f"{own}, tf long, ratio double, attribute int, bucket int, tier int"

    def query_terms(self, queries: DataFrame, query: str, q_text: str, k: int) -> DataFrame:
        """(query, token, bucket, idf, most, floor, least, essential) of the queries' tokens that the index holds.

        ``most``: the token's best part of a score; ``floor``: a lower bound of the query's k-th best score; ``least``: the
        ratio below which a posting leaves its document below the floor.
        """
        own = queries.select(query, F.explode(F.array_distinct(tokens(F.col(q_text)))).alias("token")).withColumn("bucket", bucket_of("token", self.buckets))
        rows = self.terms().join(own, ["bucket", "token"]).withColumn("idf", idf(self.n_docs))
        kth = F.coalesce(F.try_element_at("top", F.lit(k)), F.lit(0.0)) if k <= DEEPEST else F.lit(0.0)
        whole = Window.partitionBy(query)
        up = whole.orderBy("most", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = (rows.withColumn("most", F.col("idf") * F.col("top")[0]).withColumn("floor", F.max(F.col("idf") * kth).over(whole) - ROUNDING)
                .withColumn("least", (F.col("floor") - (F.sum("most").over(whole) - F.col("most"))) / F.col("idf"))
                .withColumn("essential", F.sum("most").over(up) >= F.col("floor")))
        # looking tokens up for candidates pays only where they have more postings than there may be look-ups
        ask = F.when(F.col("essential"), F.col("df"))
        spared = F.sum(F.when(~F.col("essential"), F.col("df"))).over(whole)
        looked = F.sum(ask).over(whole) * F.count(F.when(~F.col("essential"), 1)).over(whole)
        rows = rows.withColumn("spared", F.coalesce(spared, F.lit(0))).withColumn("looked", F.coalesce(looked, F.lit(0)))
        rows = rows.withColumn("essential", F.col("essential") | (F.col("spared") <= F.col("looked")))
        return rows.select(query, "token", "bucket", "idf", "most", "floor", "least", "essential")

    @property
    def blocks(self) -> int:
        """Blocks of documents that a search deals postings out to."""
        return max(1, math.ceil(self.n_docs * self.avgdl / BLOCK_TOKENS), math.ceil(self.n_docs / BLOCK_DOCS))

    def search(self, queries: DataFrame, k: int, query: str = "query_id", q_text: str = "q") -> DataFrame:
        """(query, key, score, attribute, rank): the k best documents of each query."""
        terms = _held(self.query_terms(queries, query, q_text, k), "query-terms")
        w = Window.partitionBy(query).orderBy(F.desc("score"), "attribute", self.key)
        n = self.blocks
        if n < MANY_BLOCKS:
            found = self.scores(terms, query, k)
        else:
            # the k-th best of some blocks is a floor for the others
            few = math.isqrt(n)
            first = _held(self.scores(terms, query, k, (0, few)), "first-blocks")
            kth = first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == k).select(query, (F.col("score") - ROUNDING).alias("kth"))
            raised = terms.join(kth, query, "left").withColumn("floor", F.greatest("floor", F.coalesce("kth", F.col("floor")))).drop("kth")
            found = first.unionByName(_held(self.scores(raised, query, k, (few, n)), "other-blocks"))
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    def scores(self, terms: DataFrame, query: str, k: int | None = None, blocks: tuple[int, int] | None = None) -> DataFrame:
        """(query, key, score, attribute) of every document that reaches its query's floor; with ``k``, of the best of each block."""
        ship_package(self.spark)
        tokens, asked = self.asked(terms, query)
        groups = -(-asked.count() // QUERY_ROWS) or 1
        asked = by_blocks(asked, query, groups, self.blocks, blocks)
        rows = self.in_blocks(tokens, groups)
        if blocks is not None:
            rows = rows.where(F.col("block").between(blocks[0], blocks[1] - 1))
        kinds = f"{query} {dict(terms.dtypes)[query]}, {self.key} {dict(self.postings().dtypes)[self.key]}"
        return (asked.groupBy("block", "part").cogroup(rows.groupBy("block", "part"))
                .applyInArrow(best_documents(query, self.key, k), f"{kinds}, score double, attribute int"))

    def asked(self, terms: DataFrame, query: str) -> tuple[DataFrame, DataFrame]:
        """The tokens of all queries with a number each, and (query, terms array<struct<token_id, idf>>, floor)."""
        tokens = terms.groupBy("bucket", "token").agg(F.min("least").alias("least")).withColumn("token_id", F.monotonically_increasing_id())
        tokens = _held(tokens, "query-tokens")
        numbered = terms.join(tokens.select("bucket", "token", "token_id"), ["bucket", "token"])
        return tokens, _held(numbered.groupBy(query).agg(F.collect_list(F.struct("token_id", "idf")).alias("terms"), F.max("floor").alias("floor")), "asked")

    def in_blocks(self, tokens: DataFrame, groups: int) -> DataFrame:
        """(block, part, key, token_id, ratio, attribute): postings of ``tokens``, once for each of ``groups`` groups of queries."""
        low = F.greatest(F.lit(0), F.floor(F.col("least") * TIERS / (K1 + 1))).cast("int")
        able = tokens.where(F.col("least") <= K1 + 1)  # ratios are below K1 + 1
        wanted = able.withColumn("tier", F.explode(F.sequence(F.least(low, F.lit(TIERS - 1)), F.lit(TIERS - 1))))
        hits = self.postings().join(wanted.select("bucket", "tier", "token", "token_id", "least"), ["bucket", "tier", "token"]).where(F.col("ratio") >= F.col("least"))
        return hits.select(block_of(self.key, self.blocks), parts_of(groups), self.key, "token_id", "ratio", "attribute")


def block_of(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")


def parts_of(groups: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part") if groups > 1 else F.lit(0).alias("part")


def by_blocks(asked: DataFrame, query: str, groups: int, n: int, blocks: tuple[int, int] | None = None) -> DataFrame:
    """Every query in its group, once for each block."""
    first, end = blocks or (0, n)
    grouped = asked.withColumn("part", F.pmod(F.xxhash64(query), F.lit(groups)).cast("int"))
    return grouped.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(end - 1))))


def bucket_of(token: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")
