"""Batch retrieval over a query table.

Keyword scoring is BM25 (Robertson & Zaragoza, 2009; k1 = 1.2, b = 0.75,
idf = ln(1 + (N - df + 0.5) / (df + 0.5))) over word tokens, read from a
:class:`~codeindex.operators.keyword.KeywordIndex`; vector scoring is cosine
similarity, read from a :class:`~codeindex.operators.vectors.VectorIndex`; hybrid
search scores blocks of documents by both at once. Scores are rounded to
6 decimals and ties end with the smaller document key, so the ranking is
deterministic. Every top-k is per query: ``row_number() <= k`` lets Catalyst cut each
query to k rows inside every task before the shuffle, so a query that matches
everything never lands whole in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import release
from .index import INDEX_CONFIG
from .keyword import DEEPEST, QUERY_ROWS, KeywordIndex, PostingBlock, _held, attribute_text, block_of, by_blocks, each_query, largest, parts_of
from .keyword import postings as attribute_postings
from .vectors import VectorIndex, units, usable

# Queries whose cosines with a block of documents are held at once.
COSINES = 128


# ---- Q01 -------------------------------------------------------------------

def postings(corpus: DataFrame, key: str, text: str) -> DataFrame:
    """(attribute, token, key, tf, dl) of a corpus with one searchable attribute."""
    return attribute_postings(corpus, key, {text: F.col(text)})


def top_k(scored: DataFrame, k: int, query: str = "query_id", key: str = "doc_id",
          score: str = "score") -> DataFrame:
    w = Window.partitionBy(query).orderBy(F.col(score).desc(), F.col(key).asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---- Q02 / Q03 ---------------------------------------------------------------

def search_keyword(corpus: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
                   query: str = "query_id", q_text: str = "q", index: KeywordIndex | None = None) -> DataFrame:
    """(query, key, score, attribute, rank); without ``index`` one is built over the text column."""
    index = index or KeywordIndex.build(corpus, key, {text: F.col(text)})
    return index.search(queries, k, query, q_text)


def search_vector(corpus: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", vec: str = "embedding",
                  query: str = "query_id", q_vec: str = "embedding", index: VectorIndex | None = None) -> DataFrame:
    """(query, key, score, rank); without ``index`` one is built over the vector column."""
    index = index or VectorIndex.build(corpus, key, vec)
    return index.search(queries, k, query, q_vec)


# ---- Q04 -------------------------------------------------------------------

def rounded(x: Column) -> Column:
    """Six decimals, half up, in plain floating point: ratio * (6-decimal score) often ends in an exact 5 at the 7th
    decimal, where decimal-expansion rounding and scaled rounding disagree; this form gives the same double everywhere."""
    return F.floor(x * 1e6 + 0.5) / 1e6


def search_hybrid(corpus: DataFrame, queries: DataFrame, keyword: KeywordIndex, vectors: VectorIndex, k: int = 10, ratio: float = 0.7,
                  query: str = "query_id", q_text: str = "q", q_vec: str = "embedding", depth: int | None = None) -> DataFrame:
    """ratio * max(cosine, 0) + (1 - ratio) * bm25 / max bm25 of the query, for every document of ``corpus`` (its keys).

    The largest bm25 of each query is searched first. Then blocks of documents, each with its postings and vectors, meet
    groups of queries: a block scores all its documents by both parts and hands on the k best of each query, so nothing
    but these becomes a row. Documents that score nothing at all are ordered by key: the k smallest keys are candidates
    of every query. ``depth`` is accepted for callers of the former search by ranked lists; no result depends on it.
    """
    key = keyword.key
    asked = _held(queries.select(query, q_text, q_vec), "queries")
    smallest = [r[0] for r in corpus.select(key).orderBy(key).limit(k).collect()]  # k keys
    if not smallest:
        return asked.select(query, F.lit(None).cast(dict(corpus.dtypes)[key]).alias(key), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
    best = _held(keyword.search(asked, 1, query, q_text).select(query, F.col("score").alias("best")), "keyword-best")
    found = _held(mixed_candidates(asked, best, keyword, vectors, k, ratio, query, q_text, q_vec), "hybrid-blocks")
    pairs = _held(complete(asked, found, smallest, query, key), "hybrid-candidates")
    part = F.when(F.col("best") > 0, F.col("kw") / F.col("best")).otherwise(0.0)
    mixed = pairs.join(best, query, "left").withColumn("sem", F.greatest(F.lit(0.0), F.coalesce("sem", F.lit(0.0)))).withColumn("kw", F.coalesce(part, F.lit(0.0)))
    return top_k(mixed.select(query, key, rounded(ratio * F.col("sem") + (1 - ratio) * F.col("kw")).alias("score")), k, query, key)


def complete(queries: DataFrame, found: DataFrame, smallest: list, query: str, key: str) -> DataFrame:
    """(query, key, sem, kw): ``found``, and the ``smallest`` keys that are not among them, without scores.

    A document that no block handed on is below the k-th best of its query, or scores nothing.
    """
    extra = queries.select(query, F.explode(F.array(*map(F.lit, smallest))).alias(key)).distinct()
    return found.unionByName(extra.join(found.select(query, key), [query, key], "left_anti"), allowMissingColumns=True)


def mixed_candidates(queries: DataFrame, best: DataFrame, keyword: KeywordIndex, vectors: VectorIndex, k: int, ratio: float,
                     query: str, q_text: str, q_vec: str) -> DataFrame:
    """(query, key, sem, kw) of the k best documents of each query and block, by both parts of the score."""
    key, n = keyword.key, keyword.blocks
    kind = dict(keyword.postings().dtypes)[key]
    # every posting of the queries' tokens: what the other part adds has no bound that a floor could use
    tokens, asked = keyword.asked(_held(keyword.query_terms(queries, query, q_text, DEEPEST + 1), "query-terms"), query)
    own = queries.select(query, F.when(usable(q_vec), F.col(q_vec).cast("array<double>")).alias("vec"))
    asked = _held(own.join(asked.drop("floor"), query, "left").join(best, query, "left"), "hybrid-asked")
    groups = -(-asked.count() // QUERY_ROWS) or 1
    words = keyword.in_blocks(tokens, groups).where(F.col(key).isNotNull()).withColumn("v", F.lit(None).cast("array<double>"))
    rows = vectors.rows().select(F.col("key").cast(kind).alias(key), "v").where(F.col(key).isNotNull())
    rows = rows.select(block_of(key, n), parts_of(groups), key, F.lit(None).cast("long").alias("token_id"), F.lit(None).cast("double").alias("ratio"),
                       F.lit(None).cast("int").alias("attribute"), "v")
    return (by_blocks(asked, query, groups, n).groupBy("block", "part").cogroup(words.unionByName(rows).groupBy("block", "part"))
            .applyInArrow(best_mixed(query, key, k, ratio), f"{query} {dict(queries.dtypes)[query]}, {key} {kind}, sem double, kw double"))


def best_mixed(query: str, key: str, k: int, ratio: float):
    """The k best documents of a block for each query of a group, by both parts of the score."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        block = PostingBlock(rows, key)
        # one row per vector, then the documents without one
        held = np.asarray(pc.is_valid(rows.column("v")))
        kinds = [(d, block.of_row[held][at], units(own)[0]) for d, at, own in by_length(rows.column("v").drop_null())]
        bare = np.setdiff1d(np.arange(len(block.keys)), block.of_row[held])
        doc = np.concatenate([*(x[1] for x in kinds), bare])
        first = np.cumsum([0, *(len(x[1]) for x in kinds)])
        of, at, sems, kws = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0)]
        for low in range(0, asked.num_rows, COSINES):
            some = asked.slice(low, COSINES)
            cosines = np.zeros((some.num_rows, len(doc)))
            have = np.flatnonzero(np.asarray(pc.is_valid(some.column("vec"))))
            for d, j, own in by_length(some.column("vec").drop_null()):
                for (length, _, u), a, z in zip(kinds, first[:-1], first[1:], strict=True):
                    if length == d:
                        cosines[have[j], a:z] = np.maximum(0.0, np.round(units(own)[0] @ u.T, 6))
            for j, ((tokens, idf), most) in enumerate(zip(each_query(some), some.column("best").to_pylist(), strict=True)):
                kw = np.round(block.scores(block.parts(tokens, idf)), 6)[doc]
                total = ratio * cosines[j] + (1 - ratio) * (kw / most if most else 0.0)
                total = np.floor(total * 1e6 + 0.5)
                pick = np.flatnonzero(total > 0)
                pick = pick[largest(total[pick], k)]
                pick = pick[np.lexsort((doc[pick], -total[pick]))[:k]]
                of.append(np.full(len(pick), low + j))
                at.append(doc[pick])
                sems.append(cosines[j][pick])
                kws.append(kw[pick])
        out = pa.table({query: asked.column(query).take(pa.array(np.concatenate(of))), key: block.keys.take(pa.array(np.concatenate(at))),
                        "sem": pa.array(np.concatenate(sems)), "kw": pa.array(np.concatenate(kws))})
        del block, kinds
        release()
        return out

    return run


def by_length(lists: pa.ChunkedArray):
    """(length, places, matrix) of the vectors of each length."""
    lists = lists.combine_chunks()
    lengths, flat = np.asarray(pc.list_value_length(lists)).astype(np.int64), np.asarray(lists.flatten(), np.float64)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        yield d, at, flat[(starts[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d)


# ---- Q05 / F11 / T01 / T02 --------------------------------------------------

def attribute(name: str) -> Column:
    """'metadata.class_name' -> metadata['class_name']; plain names are columns."""
    if name.startswith("metadata."):
        return F.col("metadata").getItem(name.split(".", 1)[1])
    return F.col(name)


def check_attributes(kind: str, role: str, names: list[str]) -> None:
    allowed = INDEX_CONFIG[kind][role]
    bad = [n for n in names if n not in allowed]
    if bad:
        raise ValueError(f"{bad} are not {role} attributes of a {kind} index (allowed: {allowed})")


def condition(c: Column, v) -> Column:
    """One condition on an attribute."""
    if not isinstance(v, tuple):
        return c == F.lit(v)
    kind = v[0]
    if kind == "in":
        return c.isin(*v[1])
    if kind == "has":
        return F.array_contains(c, v[1])
    if kind == "exists":
        return c.isNotNull() if v[1] else c.isNull()
    if kind == "range":
        low, high = v[1:]
        return (F.lit(True) if low is None else c >= low) & (F.lit(True) if high is None else c <= high)
    raise ValueError(f"unknown condition {kind}")


def conditions(kind: str, where: dict | None) -> Column:
    """All conditions of ``where`` on the filterable attributes of an index kind."""
    check_attributes(kind, "filterable", list(where or {}))
    cond = F.lit(True)
    for name, wanted in (where or {}).items():
        for v in wanted if isinstance(wanted, list) else [wanted]:
            cond = cond & condition(attribute(name), v)
    return cond


def filter_search(docs: DataFrame, kind: str, where: dict | None = None, sort: list[tuple[str, bool]] | None = None,
                  limit: int | None = None, key: str = "id") -> DataFrame:
    """Filter-only search: equality / IN / range / array-membership conditions, sort, limit.

    ``where`` maps attribute -> value | ('in', [...]) | ('range', lo, hi) | ('has', v) | ('exists', bool),
    or a list of these, which must all hold. Without ``limit`` all matches are returned.
    Attributes must be declared filterable / sortable for the index kind.
    """
    sort = sort or []
    check_attributes(kind, "sortable", [s for s, _ in sort])
    cond = conditions(kind, where)
    order = [(attribute(s).desc_nulls_last() if desc else attribute(s).asc_nulls_last()) for s, desc in sort]
    hits = docs.where(cond).orderBy(*order, F.col(key).asc())
    return hits if limit is None else hits.limit(limit)


# ---- one entry point over the indexed documents --------------------------------

def searchable(docs: DataFrame, kind: str) -> dict[str, Column]:
    """The texts of an index kind's searchable attributes, in rank order (arrays: one value per line)."""
    return {a: attribute_text(docs, attribute(a), a) for a in INDEX_CONFIG[kind]["searchable"]}


def search(docs: DataFrame, kind: str, queries: DataFrame | None = None, mode: str = "keyword", ratio: float = 0.7,
           where: dict | None = None, sort: list[tuple[str, bool]] | None = None, k: int | None = None, key: str = "id",
           query: str = "query_id", q_text: str = "q", q_vec: str = "embedding") -> DataFrame:
    """Search the documents of an index.

    ``mode`` is 'keyword', 'vector', 'hybrid' or 'filter'. Filters apply before scoring, so that scores, ranks and the
    top-k are those of the filtered documents. Ranked modes give (query, key, score, rank), the top ``k`` (20 if not
    given) per query; equal keyword scores go to the document that matches in the attribute of higher rank. 'filter'
    gives the documents themselves, sorted: all matches, or the first ``k``.
    """
    if mode == "filter" or queries is None:
        return filter_search(docs, kind, where, sort, k, key)
    if sort:
        raise ValueError("a ranked search is sorted by its score")
    if mode not in ("keyword", "vector", "hybrid"):
        raise ValueError(f"unknown mode {mode}")
    k = 20 if k is None else k
    kept = docs.where(conditions(kind, where))
    vectors = kept.select(key, F.col("_vectors").getItem("default").alias("_vec")) if mode != "keyword" else None
    if mode == "vector":
        return VectorIndex.build(vectors, key, "_vec").search(queries, k, query, q_vec)
    words = KeywordIndex.build(kept, key, searchable(kept, kind))
    if mode == "keyword":
        return words.search(queries, k, query, q_text)
    return search_hybrid(kept, queries, words, VectorIndex.build(vectors, key, "_vec"), k, ratio, query, q_text, q_vec)
