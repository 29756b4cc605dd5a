"""Vector index (Q03): exact cosine top-k with bounds on cells of near vectors.

``VectorIndex.build`` takes centres from a sample of at most ``SAMPLE`` vectors (by hash of the key), gives every row to
its nearest centre by angle and writes the rows in folders by cell, together with each cell's centre and largest angle
(its radius). By the triangle inequality a row of a cell at angle t from the query has a cosine of at most
cos(max(0, t - radius)).

``search`` pairs queries with cells, never with rows: each query first reads its most promising cells until they hold
enough rows, and the k-th best cosine found there tells which further cells can still matter. Queries travel as a table
dealt out by cell, in groups of bounded size, against blocks of the cell's rows; every task keeps k rows per query.

Null, empty and zero vectors have no cosine. A query meets rows of its own vector length only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_path, ship_package
from .keyword import _held

SAMPLE = 16_384
CENTRES = 1024  # at most; fewer for small tables
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
SLACK = 1e-6  # above the rounding of angles and of the 6-decimal scores


def dot(a: str, b: str) -> Column:
    """Inner product of two array columns in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def usable(vec: str) -> Column:
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))


def units(column) -> tuple[np.ndarray, np.ndarray]:
    m = np.array([np.asarray(v, np.float64) for v in column])
    n = np.linalg.norm(m, axis=1)
    return m / np.where(n > 0, n, 1)[:, None], n


def centres_of(u: np.ndarray, n: int) -> np.ndarray:
    """``n`` spread centres (each the sampled vector farthest from those before), moved to the mean of their rows."""
    chosen, near = [0], u @ u[0]
    while len(chosen) < min(n, len(u)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, u @ u[chosen[-1]])
    c = u[chosen]
    for _ in range(3):
        own = (u @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, u)
        size = np.linalg.norm(sums, axis=1)
        c = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], c)
    return c


def best_rows(query: str, key: str, k: int):
    """One group of queries against one block of rows: the k best of each query, and the products that it took."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({query: queries[query][:0], key: rows[key][:0], "score": np.empty(0), "products": np.empty(0, np.int64)})
        (q, _), (v, _) = units(queries["_q"]), units(rows["_v"])
        keys, out = rows[key].to_numpy(), []
        scores = np.round(v @ q.T, 6)
        for j, name in enumerate(queries[query]):
            s = scores[:, j]
            some = np.arange(len(s))
            if len(s) > k:  # ties with the k-th stay, the smaller key wins below
                some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
            some = some[np.lexsort((keys[some], -s[some]))[:k]]
            out.append(pd.DataFrame({query: name, key: keys[some], "score": s[some], "products": np.where(np.arange(len(some)) == 0, len(s), 0)}))
        return pd.concat(out, ignore_index=True)

    return run


@dataclass
class VectorIndex:
    spark: SparkSession
    root: str
    key: str
    key_type: str

    @classmethod
    def build(cls, corpus: DataFrame, key: str, vec: str, root: str | None = None) -> VectorIndex:
        spark = corpus.sparkSession
        ship_package(spark)
        root = root or new_path(spark, "vector-index")
        kind = dict(corpus.dtypes)[key]
        rows = corpus.where(usable(vec)).select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("v"))
        # a bounded sample of each vector length; lengths are few
        order = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("key"), "key")
        sample = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).toPandas()
        n_rows = rows.count()
        book, first = {}, 0
        for d, own in sample.groupby(sample["v"].map(len)):
            u, norm = units(own["v"])
            if (norm > 0).any():
                book[d] = first, centres_of(u[norm > 0], max(1, min(CENTRES, int(np.sqrt(n_rows)) // 4)))
                first += len(book[d][1])
        shared = spark.sparkContext.broadcast(book)  # at most CENTRES vectors of each length

        def assign(batches):
            for pdf in batches:
                for d, own in pdf.groupby(pdf["v"].map(len)):
                    start, c = shared.value.get(d, (0, None))
                    u, norm = units(own["v"])
                    own, u = own[norm > 0], u[norm > 0]
                    if c is None or not len(own):
                        continue
                    cos = u @ c.T
                    at = cos.argmax(axis=1)
                    yield pd.DataFrame({"key": own["key"].to_numpy(), "v": own["v"].to_numpy(), "cell": (start + at).astype("int32"),
                                        "angle": np.arccos(np.clip(cos[np.arange(len(at)), at], -1, 1))})

        placed = rows.mapInPandas(assign, f"key {kind}, v array<double>, cell int, angle double")
        placed.write.parquet(f"{root}/assigned")
        placed = spark.read.parquet(f"{root}/assigned")
        cells = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"))
        of = [(int(start + i), [float(x) for x in c[i]]) for start, c in book.values() for i in range(len(c))]
        known = spark.createDataFrame(of, "cell int, centre array<double>")
        cells = cells.join(known, "cell").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
        cells.write.parquet(f"{root}/cells")
        blocks = spark.read.parquet(f"{root}/cells").select("cell", "blocks")
        placed = placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).drop("blocks", "angle")
        placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{root}/rows")
        return cls(spark, root, key, kind)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"key {self.key_type}, v array<double>, block int, cell int").parquet(f"{self.root}/rows")

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/cells")

    def reach(self, queries: DataFrame, query: str, q_vec: str) -> DataFrame:
        """(query, cell, most, n, blocks): the best cosine that a cell can hold for a query; a row per query and cell."""
        own = queries.where(usable(q_vec)).select(query, F.col(q_vec).cast("array<double>").alias("_q"))
        own = own.withColumn("_n", F.sqrt(dot("_q", "_q"))).where(F.col("_n") > 0)
        pairs = own.join(self.cells(), F.size("_q") == F.size("centre"))
        angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("_q", "centre") / F.col("_n") / F.sqrt(dot("centre", "centre")))))
        return pairs.select(query, "cell", (F.cos(F.greatest(F.lit(0.0), angle - F.col("radius"))) + SLACK).alias("most"), "n", "blocks")

    def _probe(self, pairs: DataFrame, queries: DataFrame, k: int, query: str, q_vec: str) -> DataFrame:
        """The k best rows per query and block of the cells in ``pairs``: (query, key, score, products)."""
        own = queries.select(query, F.col(q_vec).cast("array<double>").alias("_q"))
        order = Window.partitionBy("cell").orderBy(query)
        # queries of a cell in groups of bounded size, each sent to the cell's blocks
        asked = pairs.withColumn("part", F.floor((F.row_number().over(order) - 1) / QUERY_ROWS).cast("int"))
        groups = asked.groupBy("cell").agg(F.max("part").alias("parts"))
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(own, query).select(query, "_q", "cell", "block", "part")
        rows = self.rows().join(groups, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts"))))
        rows = rows.select(F.col("key").alias(self.key), F.col("v").alias("_v"), F.col("cell").alias("_cell"), F.col("block").alias("_block"), F.col("part").alias("_part"))
        kind = dict(queries.dtypes)[query]
        return (asked.groupBy("cell", "block", "part").cogroup(rows.groupBy("_cell", "_block", "_part"))
                .applyInPandas(best_rows(query, self.key, k), f"{query} {kind}, {self.key} {self.key_type}, score double, products long"))

    def candidates(self, queries: DataFrame, k: int, query: str = "query_id", q_vec: str = "embedding") -> DataFrame:
        """(query, key, score, products): rows that hold each query's k best."""
        reach = _held(self.reach(queries, query, q_vec), "cell-bounds")
        by = Window.partitionBy(query).orderBy(F.desc("most"), "cell")
        before = F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        near = reach.withColumn("before", before).where(F.col("before") < k).select(query, "cell", "blocks")
        first = _held(self._probe(near, queries, k, query, q_vec), "near-cells")
        w = Window.partitionBy(query).orderBy(F.desc("score"), self.key)
        kth = first.withColumn("r", F.row_number().over(w)).where(F.col("r") == k).select(query, F.col("score").alias("kth"))
        far = (reach.join(near.select(query, "cell"), [query, "cell"], "left_anti").join(kth, query, "left")
               .where(F.col("most") >= F.coalesce("kth", F.lit(-2.0))).select(query, "cell", "blocks"))
        return first.unionByName(_held(self._probe(far, queries, k, query, q_vec), "far-cells"))

    def search(self, queries: DataFrame, k: int, query: str = "query_id", q_vec: str = "embedding") -> DataFrame:
        """(query, key, score, rank): the k best rows by cosine; equal scores go to the smaller key."""
        w = Window.partitionBy(query).orderBy(F.desc("score"), self.key)
        return self.candidates(queries, k, query, q_vec).drop("products").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
