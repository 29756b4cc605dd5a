"""Registered queries: file scan, filters, language, chunking, names (steps 1 and 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import patterns as Pt
from ..operators import chunking, documents, files as FL
from ..sources.fixtures import cte, fixture
from . import split_sql as X
from . import sqlbits as S

QUERIES: dict = {}
ORACLE: dict = {}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- shared Spark stages ---------------------------------------------------

def _entries(spark, sf):
    return fixture(spark, sf, "fx_archive_entries")


def _files(spark, sf):
    """Supported, decoded files of the archive fixture (keeps doc_id for comparison)."""
    return FL.entries_to_files(_entries(spark, sf))


def _requested_files(spark, sf):
    return FL.attach_requests(_files(spark, sf), fixture(spark, sf, "fx_repo_requests"))


# ---- shared oracle stages --------------------------------------------------

FILES_SQL = cte("fx_archive_entries", "fx_repo_requests") + f""", cleaned AS (
  SELECT doc_id, repository_id, branch, entry, content, {S.clean_path('entry')} AS file_path
  FROM fx_archive_entries WHERE NOT ends_with(entry, '/')
), files AS (
  SELECT doc_id, repository_id, branch, file_path, content, {S.language('file_path')} AS language,
         strlen(content) AS size
  FROM cleaned WHERE file_path <> '' AND NOT {S.hidden('file_path')}
    AND {S.language('file_path')} <> 'unknown'
), routed AS (
  SELECT *, {S.route('content', 'language')} AS route, {S.chunk_size('content')} AS chunk_size FROM files
)
"""


# ---- P01 / F01 / F02 / F03 / F04 / P02 / P03 / F05 / F06 -------------------

@q("clean_path")
def clean_path(spark, sf):
    e = _entries(spark, sf)
    return e.select("doc_id", "entry", C.clean_zip_path(F.col("entry")).alias("file_path"))


ORACLE["clean_path"] = cte("fx_archive_entries") + f"SELECT doc_id, entry, {S.clean_path('entry')} AS file_path FROM fx_archive_entries"


@q("filter_entries")
def filter_entries(spark, sf):
    return FL.clean_entries(_entries(spark, sf)).select("doc_id", "file_path")


ORACLE["filter_entries"] = FILES_SQL + "SELECT doc_id, file_path FROM cleaned WHERE file_path <> ''"


@q("filter_hidden")
def filter_hidden(spark, sf):
    f = FL.clean_entries(_entries(spark, sf))
    return f.where(~C.is_hidden(F.col("file_path"))).select("doc_id", "file_path")


ORACLE["filter_hidden"] = FILES_SQL + f"SELECT doc_id, file_path FROM cleaned WHERE file_path <> '' AND NOT {S.hidden('file_path')}"


@q("filter_supported")
def filter_supported(spark, sf):
    return FL.supported_files(FL.clean_entries(_entries(spark, sf))).select("doc_id", "file_path")


ORACLE["filter_supported"] = FILES_SQL + "SELECT doc_id, file_path FROM files"


@q("detect_language")
def detect_language(spark, sf):
    from ..functions.languages import with_language
    f = FL.clean_entries(_entries(spark, sf))
    return with_language(f, "file_path", "language", how="left").select("doc_id", "file_path", "language")


ORACLE["detect_language"] = FILES_SQL + f"SELECT doc_id, file_path, {S.language('file_path')} AS language FROM cleaned WHERE file_path <> ''"


@q("file_size")
def file_size(spark, sf):
    return _files(spark, sf).select("doc_id", "file_path", "size")


ORACLE["file_size"] = FILES_SQL + "SELECT doc_id, file_path, size FROM files"


@q("filter_utf8")
def filter_utf8(spark, sf):
    """Content landed as bytes (as an archive entry is), validated and decoded."""
    e = _entries(spark, sf).withColumn("content", F.encode(F.col("content"), "UTF-8"))
    f = FL.entries_to_files(e)
    return f.select("doc_id", "file_path", "size", F.length("content").alias("n_chars"))


ORACLE["filter_utf8"] = FILES_SQL + "SELECT doc_id, file_path, size, length(content) AS n_chars FROM files"


@q("filter_blank")
def filter_blank(spark, sf):
    return _files(spark, sf).where(~C.is_blank(F.col("content"))).select("doc_id", "file_path")


ORACLE["filter_blank"] = FILES_SQL + f"SELECT doc_id, file_path FROM files WHERE {S.not_blank('content')}"


@q("size_policy")
def size_policy(spark, sf):
    f = _files(spark, sf)
    return f.select("doc_id", F.length("content").alias("n_chars"),
                    C.size_class_chunk(F.col("content")).alias("chunk_size"))


ORACLE["size_policy"] = FILES_SQL + f"SELECT doc_id, length(content) AS n_chars, {S.chunk_size('content')} AS chunk_size FROM files"


@q("scan_stats")
def scan_stats(spark, sf):
    return FL.scan_stats(_entries(spark, sf))


ORACLE["scan_stats"] = FILES_SQL + """SELECT e.repository_id, count(*) AS entries_seen,
  count(f.doc_id) AS files_kept
FROM fx_archive_entries e LEFT JOIN files f ON e.doc_id = f.doc_id GROUP BY e.repository_id"""


@q("join_request_files")
def join_request_files(spark, sf):
    return _requested_files(spark, sf).select("doc_id", "file_path", "owner", "repo_name", "branch")


ORACLE["join_request_files"] = FILES_SQL + """SELECT f.doc_id, f.file_path, r.owner, r.repo_name, r.branch
FROM files f JOIN fx_repo_requests r USING (repository_id, branch)"""


# ---- routing, chunk rows, ids (G01 G08 P04-P07 P12-P14 A05 A06) -------------

@q("chunk_route")
def chunk_route(spark, sf):
    r = chunking.with_route(_files(spark, sf))
    return r.select("doc_id", "route", "chunk_size")


ORACLE["chunk_route"] = FILES_SQL + "SELECT doc_id, route, chunk_size FROM routed"


_KNOWN = ["src", "file_id", "repository_id", "owner", "repo_name", "branch", "file_path", "language", "content"]


def _known_files(spark, sf):
    """All requested archive files, and made ones for the Java route and for blocks of known cuts."""
    archive = _requested_files(spark, sf).withColumn("src", F.lit("archive")).withColumnRenamed("doc_id", "file_id")
    made = [_java_fixture_files(spark, sf).withColumn("src", F.lit("java")), _block_files(spark, sf).withColumn("src", F.lit("split"))]
    out = archive.select(*_KNOWN)
    for f in made:
        out = out.unionByName(f.withColumns({"owner": F.lit("org1"), "repo_name": F.lit("parts"), "branch": F.lit("main"),
                                             "repository_id": F.lit(1).cast("long")}).select(*_KNOWN))
    return out


# Their chunks (c), file by file.
SPLIT_SQL = FILES_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", " + X.chunks("routed", "doc_id") + "\n"
KNOWN_SQL = SPLIT_SQL + ", " + cte("fx_java_files", "fx_split_files")[5:] + """, known AS (
  SELECT 'archive' AS src, doc_id AS file_id, f.repository_id, r.owner, r.repo_name, r.branch, file_path, language, chunk_index, c
  FROM pieces JOIN routed f USING (doc_id) JOIN fx_repo_requests r USING (repository_id, branch)
""" + "".join(f"""  UNION ALL SELECT 'java', file_id, 1, 'org1', 'parts', 'main', file_path, 'java', {i}, {c} FROM fx_java_files
""" for i, c in enumerate(["substr(p_head, 1, length(p_head) - 1)", "p_m1", "p_m2"])) + "".join(
    f"""  UNION ALL SELECT 'split', file_id, 1, 'org1', 'parts', 'main', file_path, language, {i}, ltrim(b{i}, chr(10)) FROM fx_split_files WHERE n_blocks > {i}
""" for i in range(5)) + ")\n"


@q("chunk_header")
def chunk_header(spark, sf):
    ch = chunking.chunk_records(_known_files(spark, sf))
    return ch.select("src", "file_id", "chunk_index", F.col("chunk_text").alias("text"))


ORACLE["chunk_header"] = KNOWN_SQL + "SELECT src, file_id, chunk_index, concat('File: ', file_path, chr(10), chr(10), c) AS text FROM known"


@q("chunk_ids")
def chunk_ids(spark, sf):
    return chunking.chunk_records(_known_files(spark, sf)).select("src", "file_id", "chunk_id")


ORACLE["chunk_ids"] = KNOWN_SQL + """SELECT src, file_id,
  concat('repo_', CAST(repository_id AS VARCHAR), '_', file_path, '_', CAST(chunk_index AS VARCHAR)) AS chunk_id FROM known"""


@q("code_doc_ids")
def code_doc_ids(spark, sf):
    return documents.code_documents(_known_files(spark, sf)).select("id", "file_path", "chunk_index")


ORACLE["code_doc_ids"] = KNOWN_SQL + f"SELECT {S.code_doc_id('repository_id', 'file_path', 'chunk_index')} AS id, file_path, chunk_index FROM known"


@q("code_documents")
def code_documents(spark, sf):
    """Flagship: archive entries -> filtered files -> routed chunks -> code documents."""
    d = documents.code_documents(_requested_files(spark, sf))
    return d.select("id", "sourceType", "file_path", "category", "source", "text", "repository_id", "owner",
                    "language", "html_url", "index_name", "chunk_index",
                    F.col("metadata").getItem("class_name").alias("meta_class_name"),
                    F.col("metadata").getItem("function_name").alias("meta_function_name"))


@q("code_documents_whole")
def code_documents_whole(spark, sf):
    """All document columns of the files of every route, made ones included."""
    d = documents.code_documents(_known_files(spark, sf))
    return d.select("id", "sourceType", "file_path", "category", "source", "text", "repository_id", "owner",
                    "language", "html_url", "index_name", "chunk_index",
                    F.col("metadata").getItem("class_name").alias("meta_class_name"),
                    F.col("metadata").getItem("function_name").alias("meta_function_name"))


_DOCUMENTS_SQL = KNOWN_SQL + f"""SELECT {S.code_doc_id('repository_id', 'file_path', 'chunk_index')} AS id,
  0 AS sourceType, file_path, 'CODE' AS category, concat(repo_name, '@', branch) AS source,
  concat('File: ', file_path, chr(10), chr(10), c) AS text, repository_id, owner, language,
  concat('https://github.com/', owner, '/', repo_name, '/blob/', branch, '/', file_path) AS html_url,
  {S.index_name('repo_name', 'branch', '_code')} AS index_name, chunk_index,
  {S.extract_class('c', 'language')} AS meta_class_name,
  {S.extract_function('c', 'language')} AS meta_function_name
FROM known"""
ORACLE["code_documents_whole"] = _DOCUMENTS_SQL
ORACLE["code_documents"] = _DOCUMENTS_SQL + " WHERE src = 'archive'"


@q("extract_class")
def extract_class(spark, sf):
    f = fixture(spark, sf, "fx_code_files")
    return f.select("doc_id", C.extract_class(F.col("content"), F.col("language")).alias("class_name"))


ORACLE["extract_class"] = cte("fx_code_files") + "SELECT doc_id, want_class AS class_name FROM fx_code_files"


@q("extract_function")
def extract_function(spark, sf):
    f = fixture(spark, sf, "fx_code_files")
    return f.select("doc_id", C.extract_function(F.col("content"), F.col("language")).alias("function_name"))


ORACLE["extract_function"] = cte("fx_code_files") + "SELECT doc_id, want_func AS function_name FROM fx_code_files"


@q("chunk_metadata")
def chunk_metadata(spark, sf):
    f = fixture(spark, sf, "fx_code_files")
    named = chunking.with_names(f, text="content")
    return named.select("doc_id", F.col("metadata").getItem("class_name").alias("class_name"),
                        F.col("metadata").getItem("function_name").alias("function_name"),
                        F.size("metadata").alias("n_names"))


ORACLE["chunk_metadata"] = cte("fx_code_files") + """SELECT doc_id, want_class AS class_name, want_func AS function_name,
  (CASE WHEN want_class IS NULL THEN 0 ELSE 1 END) + (CASE WHEN want_func IS NULL THEN 0 ELSE 1 END) AS n_names
FROM fx_code_files"""


def _java_fixture_files(spark, sf):
    j = fixture(spark, sf, "fx_java_files")
    return j.select("file_id", "file_path", F.lit(1).alias("repository_id"), F.lit("java").alias("language"),
                    F.concat("p_head", "p_m1", "p_m2", "p_tail").alias("content"))


@q("java_gate")
def java_gate(spark, sf):
    j = _java_fixture_files(spark, sf).select(F.lit("fixture").alias("src"), F.col("file_id").alias("id"),
                                              "content", "language")
    a = _files(spark, sf).where(F.col("language") == "java").select(
        F.lit("archive").alias("src"), F.col("doc_id").alias("id"), "content", "language")
    both = j.unionByName(a)
    return both.select("src", "id", C.java_signature_count(F.col("content")).alias("n_signatures"),
                       C.java_gate(F.col("content"), F.col("language")).alias("gate"))


ORACLE["java_gate"] = FILES_SQL.replace("WITH ", "WITH " + cte("fx_java_files")[5:] + ",\n", 1) + f""", jfiles AS (
  SELECT 'fixture' AS src, file_id AS id, concat(p_head, p_m1, p_m2, p_tail) AS content, 'java' AS language FROM fx_java_files
  UNION ALL SELECT 'archive', doc_id, content, language FROM files WHERE language = 'java')
SELECT src, id, {S.rx_count('content', Pt.JAVA_GATE_METHOD)} AS n_signatures,
  {S.java_gate('content', 'language')} AS gate FROM jfiles"""


@q("java_chunks")
def java_chunks(spark, sf):
    ch = chunking.chunk_files(_java_fixture_files(spark, sf))
    return ch.select("file_id", "chunk_index", F.col("chunk_raw").alias("chunk"))


ORACLE["java_chunks"] = cte("fx_java_files") + """SELECT file_id, 0 AS chunk_index, substr(p_head, 1, length(p_head) - 1) AS chunk FROM fx_java_files
UNION ALL SELECT file_id, 1, p_m1 FROM fx_java_files
UNION ALL SELECT file_id, 2, p_m2 FROM fx_java_files"""


@q("chunk_stats")
def chunk_stats(spark, sf):
    """A06 over the chunks of every route."""
    return chunking.chunk_files(_known_files(spark, sf)).groupBy("src", "language").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.count_distinct("file_path").alias("n_files"),
        F.round(F.avg(F.length("chunk_raw")), 6).alias("avg_chars"))


ORACLE["chunk_stats"] = KNOWN_SQL + """SELECT src, language, count(*) AS n_chunks, count(DISTINCT file_path) AS n_files,
  round(avg(length(c)), 6) AS avg_chars FROM known GROUP BY src, language"""


def _split_chunks(spark, sf):
    return chunking.chunk_files(_files(spark, sf)).where(F.col("route") == "split")


@q("split_code")
def split_code(spark, sf):
    from ..operators.splitter import SEPARATORS
    ch = _split_chunks(spark, sf).where(F.col("language").isin(*SEPARATORS))
    return ch.select("doc_id", "language", "chunk_size", "chunk_index", F.col("chunk_raw").alias("chunk"))


@q("split_generic")
def split_generic(spark, sf):
    from ..operators.splitter import SEPARATORS
    ch = _split_chunks(spark, sf).where(~F.col("language").isin(*SEPARATORS))
    return ch.select("doc_id", "language", "chunk_size", "chunk_index", F.col("chunk_raw").alias("chunk"))


_SPLIT_LANGUAGES = ", ".join(f"'{k}'" for k in X.SEPARATORS if k)
_SPLIT_COLUMNS = "SELECT doc_id, language, chunk_size, chunk_index, c AS chunk FROM pieces JOIN routed USING (doc_id) WHERE route = 'split'"
ORACLE["split_code"] = SPLIT_SQL + _SPLIT_COLUMNS + f" AND language IN ({_SPLIT_LANGUAGES})"
ORACLE["split_generic"] = SPLIT_SQL + _SPLIT_COLUMNS + f" AND language NOT IN ({_SPLIT_LANGUAGES})"


@q("split_invariants")
def split_invariants(spark, sf):
    """Per split-route file: chunks within size, indexes contiguous, no visible character lost."""
    f = _files(spark, sf)
    ch = _split_chunks(spark, sf)
    per = ch.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("chunk_raw")).alias("max_len"),
        F.min("chunk_index").alias("lo"), F.max("chunk_index").alias("hi"),
        F.max("chunk_size").alias("size"), F.sum(C.non_ws_count(F.col("chunk_raw"))).alias("kept"))
    whole = f.select("doc_id", C.non_ws_count(F.col("content")).alias("total"))
    j = per.join(whole, "doc_id")
    return j.select("doc_id",
                    ((F.col("max_len") <= F.col("size")) | (F.col("n") == 1)).alias("within_size"),
                    ((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).alias("contiguous"),
                    (F.col("kept") == F.col("total")).alias("covered"))


ORACLE["split_invariants"] = FILES_SQL + "SELECT doc_id, true AS within_size, true AS contiguous, true AS covered FROM routed WHERE route = 'split'"


@q("chunk_index")
def chunk_index(spark, sf):
    """The position of every piece of a file, on every route."""
    ch = chunking.chunk_files(_known_files(spark, sf))
    return ch.select("src", "file_id", "chunk_index", F.col("chunk_raw").alias("piece"))


ORACLE["chunk_index"] = KNOWN_SQL + "SELECT src, file_id, chunk_index, c AS piece FROM known"


def _block_files(spark, sf):
    f = fixture(spark, sf, "fx_split_files")
    text = F.concat("b0", "b1", *[F.when(F.col("n_blocks") > i, F.col(f"b{i}")).otherwise("") for i in (2, 3, 4)])
    return f.select("file_id", "file_path", "language", F.lit(1).alias("repository_id"), text.alias("content"))


@q("split_exact")
def split_exact(spark, sf):
    """G06 + G07: files of several blocks, each too long to share a chunk, by language and generic separators."""
    ch = chunking.chunk_files(_block_files(spark, sf))
    return ch.select("file_id", "route", "chunk_index", F.col("chunk_raw").alias("chunk"))


ORACLE["split_exact"] = cte("fx_split_files") + " UNION ALL ".join(
    f"SELECT file_id, 'split' AS route, {i} AS chunk_index, ltrim(b{i}, chr(10)) AS chunk FROM fx_split_files WHERE n_blocks > {i}" for i in range(5))
