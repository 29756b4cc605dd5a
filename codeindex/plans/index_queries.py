"""Registered queries: index sinks, embeddings, search (steps 4 and 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import documents, embed as EM, index as IX, keyword as KW, pulls as PR, search as SR
from ..operators.keyword import KeywordIndex
from ..operators.vectors import VectorIndex
from ..session import new_path
from ..sources.fixtures import cte, fixture
from . import pr_queries as PQ
from . import sqlbits as S

QUERIES: dict = {}
ORACLE: dict = {}
TEST_DIM = 64
RX = S.lit(EM.TOKEN_SPLIT)


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- K01 / W01 / U02: upserts ----------------------------------------------------

@q("upsert_code_index")
def upsert_code_index(spark, sf):
    batches = fixture(spark, sf, "fx_index_batches").withColumn(
        "index_name", F.concat(F.col("source"), F.lit("_code")))
    table = IX.IndexTable(spark, new_path(spark, "code-index"))
    for b in (1, 2):
        table.write_batch(batches.where(F.col("batch_no") == b).drop("batch_no"), b, check_empty=False)
    return table.read().select("index_name", "id", "text", "language", "source")


ORACLE["upsert_code_index"] = cte("fx_index_batches") + """SELECT index_name, id, text, language, source FROM (
  SELECT *, concat(source, '_code') AS index_name,
         row_number() OVER (PARTITION BY concat(source, '_code'), id ORDER BY batch_no DESC) AS rn
  FROM fx_index_batches) t WHERE rn = 1"""


@q("upsert_pr_index")
def upsert_pr_index(spark, sf):
    """PR documents arrive with the request log in two batches (by request id parity); replays collapse."""
    reqs = PQ.pr_requests_df(spark, sf)
    recs = PQ.records_df(spark, sf)
    recs = recs.where(PR.is_valid(recs))
    table = IX.IndexTable(spark, new_path(spark, "pr-index"))
    for b in (0, 1):
        docs = PR.pr_documents(reqs.where(F.col("request_id") % 2 == b), recs)
        table.write_batch(docs, b + 1, check_empty=False)
    return table.read().select("index_name", "id", "pr_number", "repository_id", "title", "search_text")


ORACLE["upsert_pr_index"] = PQ.PULLS_SQL + "SELECT index_name, id, pr_number, repository_id, title, search_text FROM docs"


@q("index_names")
def index_names(spark, sf):
    code = PQ.repo_requests_df(spark, sf).select(
        "repository_id", C.index_name(F.col("repo_name"), F.col("branch"), "_code").alias("index_name"))
    pr = PQ.pr_requests_df(spark, sf).select(
        "repository_id", C.index_name(F.col("repo_name"), F.col("branch"), "_pr").alias("index_name"))
    return code.unionByName(pr).distinct()


ORACLE["index_names"] = cte("fx_repo_requests", "fx_pr_request_log") + f"""SELECT DISTINCT repository_id, {S.index_name('repo_name', 'branch', '_code')} AS index_name FROM fx_repo_requests
UNION SELECT DISTINCT repository_id, {S.index_name('repo_name', 'branch', '_pr')} FROM fx_pr_request_log"""


def _index_kinds(spark, sf):
    n = index_names(spark, sf)
    return n.select("index_name", F.when(F.col("index_name").endswith("_pr"), "pr").otherwise("code").alias("kind"))


@q("index_catalogue")
def index_catalogue(spark, sf):
    return IX.catalogue(spark, _index_kinds(spark, sf)).select(
        "index_name", "kind", "role", "attribute", "rank", "dims", "primary_key")


# Attributes of each kind of index by role, in rank order, and the vector size.
CATALOGUE = """cfg(kind, role, attributes) AS (VALUES
  ('code', 'searchable', ['text', 'file_path', 'metadata.class_name', 'metadata.function_name']),
  ('code', 'filterable', ['repository_id', 'owner', 'language', 'category', 'source', 'metadata.class_name', 'metadata.function_name']),
  ('code', 'sortable', ['repository_id']),
  ('pr', 'searchable', ['title', 'body', 'commit_messages', 'changed_files']),
  ('pr', 'filterable', ['repository_id', 'owner', 'repo_name', 'state', 'author', 'labels', 'milestone', 'changed_files', 'created_at', 'updated_at',
                        'merged_at', 'closed_at', 'changed_files_count', 'additions', 'deletions']),
  ('pr', 'sortable', ['created_at', 'updated_at', 'merged_at', 'closed_at', 'changed_files_count', 'additions', 'deletions']))"""


ORACLE["index_catalogue"] = cte("fx_repo_requests", "fx_pr_request_log") + f""", names AS (
  SELECT DISTINCT {S.index_name('repo_name', 'branch', '_code')} AS index_name, 'code' AS kind FROM fx_repo_requests
  UNION SELECT DISTINCT {S.index_name('repo_name', 'branch', '_pr')}, 'pr' FROM fx_pr_request_log
), {CATALOGUE}
SELECT index_name, kind, role, attributes[rank + 1] AS attribute, CAST(rank AS INT) AS rank, 3072 AS dims, 'id' AS primary_key
FROM names JOIN cfg USING (kind), unnest(range(len(attributes))) AS t(rank)"""


@q("docs_per_index")
def docs_per_index(spark, sf):
    return IX.docs_per_index(PQ.pr_docs_df(spark, sf))


ORACLE["docs_per_index"] = PQ.PULLS_SQL + "SELECT index_name, count(*) AS n_docs FROM docs GROUP BY index_name"


# ---- E01 / E02 / E04 / J05 / P21 --------------------------------------------------

def _weights_sql(src: str, key: str, text: str, dim: int = TEST_DIM) -> str:
    return f"""SELECT {key}, bucket, CAST(sum(sgn) AS BIGINT) AS weight FROM (
  SELECT {key}, CAST(('0x' || substr(md5(tok), 1, 7)) AS BIGINT) % {dim} AS bucket,
         CASE WHEN CAST(('0x' || substr(md5(tok), 8, 1)) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END AS sgn
  FROM (SELECT {key}, unnest(string_split_regex(lower({text}), {RX})) AS tok FROM {src}) t WHERE tok <> '') u
GROUP BY {key}, bucket HAVING sum(sgn) <> 0"""


@q("embed_hash")
def embed_hash(spark, sf):
    # row by row: a rebalance spreads the texts over tasks, whatever the layout of the file
    docs = fixture(spark, sf, "fx_code_files").select("doc_id", "content").hint("rebalance")
    emb = EM.hash_embed(docs, "doc_id", "content", TEST_DIM)
    return (emb.select("doc_id", F.posexplode("embedding").alias("bucket", "w"))
               .where(F.col("w") != 0).select("doc_id", F.col("bucket").cast("long").alias("bucket"),
                                               F.col("w").cast("long").alias("weight")))


ORACLE["embed_hash"] = cte("fx_code_files") + _weights_sql("fx_code_files", "doc_id", "content")


@q("embed_valid")
def embed_valid(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.select("vec_id", F.size("embedding").alias("dims"),
                    EM.valid_dims(F.col("embedding"), TEST_DIM).alias("valid_64"),
                    EM.valid_dims(F.col("embedding"), IX.VECTOR_DIMS).alias("valid_index"))


ORACLE["embed_valid"] = f"SELECT vec_id, len(embedding) AS dims, len(embedding) = 64 AS valid_64, len(embedding) = {IX.VECTOR_DIMS} AS valid_index FROM embeddings"


@q("embed_pr")
def embed_pr(spark, sf):
    docs = PQ.pr_docs_df(spark, sf).select("id", "search_text")
    w = EM.hash_weights(docs, "id", "search_text", TEST_DIM)
    return w


ORACLE["embed_pr"] = PQ.PULLS_SQL + ", d AS (SELECT id, search_text FROM docs)\n" + _weights_sql("d", "id", "search_text")


@q("attach_vectors")
def attach_vectors(spark, sf):
    out = EM.embedded(PQ.pr_docs_df(spark, sf), "search_text", TEST_DIM)
    v = F.col("_vectors").getItem("default")
    return out.select("id", "pr_number", F.size(v).alias("dims"),
                      F.size(F.filter(v, lambda x: x != 0)).alias("nonzero"))


ORACLE["attach_vectors"] = PQ.PULLS_SQL + f""", d AS (SELECT id, pr_number, search_text FROM docs),
w AS ({_weights_sql('d', 'id', 'search_text')})
SELECT d.id, d.pr_number, {TEST_DIM} AS dims, count(w.bucket) AS nonzero FROM d LEFT JOIN w ON d.id = w.id GROUP BY d.id, d.pr_number"""


# ---- Q01-Q05 -----------------------------------------------------------------------

def corpus_df(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    lb = spark.read.parquet(f"{sf}/labels.parquet")
    return d.join(lb, "doc_id", "left").select("doc_id", "text", "lang", "source", "quality")


def queries_df(spark, sf):
    return fixture(spark, sf, "fx_search_queries")


@q("postings")
def postings_q(spark, sf):
    return SR.postings(corpus_df(spark, sf), "doc_id", "text").select("attribute", "doc_id", "token", "tf", "dl")


TOKS_SQL = f"""toks AS (SELECT doc_id, tok AS token FROM (SELECT doc_id, unnest(string_split_regex(lower(text), {RX})) AS tok FROM documents) t WHERE tok <> ''),
dl AS (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id),
stats AS (SELECT count(*) AS n_docs, avg(coalesce(dl.dl, 0)) AS avgdl FROM documents LEFT JOIN dl USING (doc_id))"""

ORACLE["postings"] = f"WITH {TOKS_SQL}\nSELECT 'text' AS attribute, doc_id, token, count(*) AS tf, max(dl) AS dl FROM toks JOIN dl USING (doc_id) GROUP BY doc_id, token"

BM25_SQL = cte("fx_search_queries") + f""", {TOKS_SQL},
qt AS (SELECT DISTINCT query_id, tok AS token FROM (SELECT query_id, unnest(string_split_regex(lower(q), {RX})) AS tok FROM fx_search_queries) t WHERE tok <> ''),
tf AS (SELECT doc_id, token, count(*) AS tf FROM toks WHERE token IN (SELECT token FROM qt) GROUP BY doc_id, token),
dfs AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
kw AS (SELECT query_id, doc_id, round(sum(ln(1 + (n_docs - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST({KW.K1 + 1} AS DOUBLE)
             / (tf + CAST({KW.K1} AS DOUBLE) * (1 - CAST({KW.B} AS DOUBLE) + CAST({KW.B} AS DOUBLE) * dl / avgdl))), 6) AS score
       FROM qt JOIN tf USING (token) JOIN dfs USING (token) JOIN dl USING (doc_id) CROSS JOIN stats
       GROUP BY query_id, doc_id)
"""


_INDEXES: dict = {}


def _once(spark, sf, name, build):
    """An index of a table folder, built once per session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _INDEXES:
        _INDEXES[key] = build()
    return _INDEXES[key]


def keyword_index(spark, sf):
    return _once(spark, sf, "keyword", lambda: KeywordIndex.build(corpus_df(spark, sf), "doc_id", {"text": F.col("text")}))


def vector_index(spark, sf):
    return _once(spark, sf, "vectors", lambda: VectorIndex.build(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding"))


def text_vector_index(spark, sf):
    """Hash embeddings of the documents' texts."""
    # the embedding is row-local: spread the documents first (the table file may be one row group)
    return _once(spark, sf, "text-vectors", lambda: VectorIndex.build(
        EM.hash_embed(corpus_df(spark, sf).repartition("doc_id"), "doc_id", "text", TEST_DIM), "doc_id", "embedding"))


@q("search_keyword")
def search_keyword(spark, sf):
    return keyword_index(spark, sf).search(queries_df(spark, sf), 10).select(
        "query_id", "doc_id", "score", "rank")


ORACLE["search_keyword"] = BM25_SQL + """SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM kw) t WHERE rank <= 10"""


def _query_vectors(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return queries_df(spark, sf).join(e.select(F.col("vec_id").alias("query_vec_id"), "embedding"), "query_vec_id")


@q("search_vector")
def search_vector(spark, sf):
    return vector_index(spark, sf).search(_query_vectors(spark, sf), 10).select(
        "query_id", "vec_id", "score", "rank")


ORACLE["search_vector"] = cte("fx_search_queries") + """SELECT query_id, vec_id, score, rank FROM (
  SELECT q.query_id, e.vec_id, round(list_cosine_similarity(CAST(qe.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS score,
         row_number() OVER (PARTITION BY q.query_id ORDER BY round(list_cosine_similarity(CAST(qe.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) DESC, e.vec_id) AS rank
  FROM fx_search_queries q JOIN embeddings qe ON qe.vec_id = q.query_vec_id CROSS JOIN embeddings e) t WHERE rank <= 10"""


@q("search_hybrid")
def search_hybrid(spark, sf):
    qs = EM.hash_embed(queries_df(spark, sf), "query_id", "q", TEST_DIM)
    return SR.search_hybrid(corpus_df(spark, sf), qs, keyword_index(spark, sf), text_vector_index(spark, sf), k=10, ratio=0.7).select(
        "query_id", "doc_id", "score", "rank")


ORACLE["search_hybrid"] = BM25_SQL + f""", dw AS ({_weights_sql('documents', 'doc_id', 'text')}),
qw AS ({_weights_sql('fx_search_queries', 'query_id', 'q')}),
dn AS (SELECT doc_id, sqrt(sum(weight * weight)) AS n FROM dw GROUP BY doc_id),
qn AS (SELECT query_id, sqrt(sum(weight * weight)) AS n FROM qw GROUP BY query_id),
dot AS (SELECT query_id, doc_id, sum(qw.weight * dw.weight) AS d FROM qw JOIN dw USING (bucket) GROUP BY query_id, doc_id),
sem AS (SELECT query_id, doc_id, round(d / (qn.n * dn.n), 6) AS sem FROM dot JOIN qn USING (query_id) JOIN dn USING (doc_id)),
best AS (SELECT query_id, max(score) AS best FROM kw GROUP BY query_id),
kwn AS (SELECT query_id, doc_id, CASE WHEN best > 0 THEN score / best ELSE 0 END AS kw FROM kw JOIN best USING (query_id)),
allp AS (SELECT q.query_id, d.doc_id FROM fx_search_queries q CROSS JOIN documents d),
scored AS (SELECT a.query_id, a.doc_id,
  floor((CAST(0.7 AS DOUBLE) * greatest(coalesce(sem.sem, 0), 0) + (1 - CAST(0.7 AS DOUBLE)) * coalesce(kwn.kw, 0))
        * CAST(1e6 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1e6 AS DOUBLE) AS score
  FROM allp a LEFT JOIN sem USING (query_id, doc_id) LEFT JOIN kwn USING (query_id, doc_id))
SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored) t WHERE rank <= 10"""


def _java_code_docs(spark, sf):
    j = fixture(spark, sf, "fx_java_files")
    files = j.select((F.col("file_id") % 20).alias("repository_id"), "file_path", F.lit("java").alias("language"),
                     F.concat("p_head", "p_m1", "p_m2", "p_tail").alias("content"),
                     F.concat(F.lit("org"), (F.col("file_id") % 5).cast("string")).alias("owner"),
                     F.lit("parts").alias("repo_name"), F.lit("main").alias("branch"))
    return documents.code_documents(files)


@q("search_filter_code")
def search_filter_code(spark, sf):
    docs = _java_code_docs(spark, sf)
    hits = SR.filter_search(docs, "code", where={"repository_id": 3, "metadata.function_name": ("exists", True),
                                                 "language": "java"}, limit=25)
    return hits.select("id", "file_path", F.col("metadata").getItem("function_name").alias("function_name"))


ORACLE["search_filter_code"] = cte("fx_java_files") + f""", chunks AS (
  SELECT file_id, file_path, 1 AS i, p_m1 AS c FROM fx_java_files
  UNION ALL SELECT file_id, file_path, 2, p_m2 FROM fx_java_files)
SELECT {S.code_doc_id('file_id % 20', 'file_path', 'i')} AS id, file_path,
       {S.extract_function('c', "'java'")} AS function_name
FROM chunks WHERE file_id % 20 = 3 ORDER BY id LIMIT 25"""


@q("search_filter_pr")
def search_filter_pr(spark, sf):
    docs = PQ.pr_docs_df(spark, sf)
    hits = SR.filter_search(docs, "pr", where={"labels": ("has", "x"), "state": "closed",
                                               "created_at": ("range", 788918400, 852076800)}, limit=20)
    return PQ.joined_arrays(hits.select("id", "pr_number", "state", "labels", "created_at"))


ORACLE["search_filter_pr"] = PQ.PULLS_SQL + """SELECT id, pr_number, state, labels, created_at FROM docs
WHERE ('|' || labels || '|') LIKE '%|x|%' AND state = 'closed' AND created_at BETWEEN 788918400 AND 852076800
ORDER BY id LIMIT 20"""


@q("search_sort_pr")
def search_sort_pr(spark, sf):
    docs = PQ.pr_docs_df(spark, sf)
    hits = SR.filter_search(docs, "pr", where={"state": "open"}, sort=[("additions", True), ("closed_at", False)],
                            limit=20)
    return hits.select("id", "pr_number", "additions", "closed_at")


ORACLE["search_sort_pr"] = PQ.PULLS_SQL + """SELECT id, pr_number, additions, closed_at FROM docs WHERE state = 'open'
ORDER BY additions DESC NULLS LAST, closed_at ASC NULLS LAST, id LIMIT 20"""


@q("search_index_pr")
def search_index_pr(spark, sf):
    """Keyword search over all searchable attributes of the closed pull requests."""
    return SR.search(PQ.pr_docs_df(spark, sf), "pr", queries_df(spark, sf), where={"state": "closed"}, k=5).select("query_id", "id", "score", "attribute", "rank")


PR_ATTRIBUTES = ["title", "body", "commit_messages", "changed_files"]  # fixed values: searchable attributes in rank order
# each attribute's tokens once more, for the rank of the first attribute that matches
_ATTRIBUTE_TOKENS = " UNION ALL ".join(
    f"SELECT id, {i} AS attribute, unnest(string_split_regex(lower({a}), {RX})) AS token FROM docs WHERE state = 'closed'" for i, a in enumerate(PR_ATTRIBUTES))
ORACLE["search_index_pr"] = PQ.PULLS_SQL.rstrip() + ", " + cte("fx_search_queries")[5:].rstrip() + f""", corp AS (
  SELECT id, concat_ws(chr(10), {', '.join(PR_ATTRIBUTES)}) AS text FROM docs WHERE state = 'closed'),
first AS (SELECT id, token, min(attribute) AS attribute FROM ({_ATTRIBUTE_TOKENS}) t GROUP BY id, token)
""" + BM25_SQL[len(cte("fx_search_queries")):].replace("documents", "corp").replace("doc_id", "id") + """, ranked AS (
  SELECT query_id, kw.id, any_value(score) AS score, CAST(min(attribute) AS INT) AS attribute FROM kw JOIN qt USING (query_id)
  JOIN first ON first.id = kw.id AND first.token = qt.token GROUP BY query_id, kw.id)
SELECT query_id, id, score, attribute, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, attribute, id) AS rank FROM ranked) t WHERE rank <= 5"""
