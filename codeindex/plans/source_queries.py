"""Registered queries: archives, tree/blob scans, routing, reject log (steps 4 and 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import files as FL, index as IX, pulls as PR
from ..session import new_path
from ..sources import archives as AR, tree as TR
from ..sources.fixtures import cte, fixture
from ..sources.landing import landed
from ..streaming.sync import RepoSources, routed, routed_files
from . import files_queries as FQ
from . import pr_queries as PQ
from . import sqlbits as S

QUERIES: dict = {}
ORACLE: dict = {}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_ARCHIVES: dict = {}


def archives_df(spark, sf, damaged=None):
    """fx_archive_entries as zip files (one or more per repository and branch); archives where ``damaged`` holds are cut short."""
    key = (spark.sparkContext.applicationId, sf, damaged)
    if key not in _ARCHIVES:
        _ARCHIVES[key] = new_path(spark, "archives")
        AR.land_archives(fixture(spark, sf, "fx_archive_entries"), _ARCHIVES[key], None if damaged is None else F.expr(damaged))
    return AR.read_archives(spark, _ARCHIVES[key])


def trees_df(spark, sf):
    path = landed(spark, sf, "trees", lambda: TR.trees_payload(fixture(spark, sf, "fx_tree_items")), by="repository_id")
    return TR.read_trees(spark, path)


def blobs_df(spark, sf):
    path = landed(spark, sf, "blobs", lambda: TR.blobs_payload(fixture(spark, sf, "fx_tree_items")), by="repository_id")
    return TR.read_blobs(spark, path)


def archive_sql(damaged: str = "false") -> str:
    """Archives of each repository and branch: entries are stored, so a file's length follows from names and contents.

    Fixed values: 30 + 46 bytes of headers per entry, which hold its name twice, and 22 bytes at the end of a zip file.
    """
    return f"""arch AS (
  SELECT repository_id, branch, parts, CASE WHEN {damaged} THEN 20 * parts ELSE 22 * parts + entry_bytes END AS n_bytes FROM (
    SELECT repository_id, branch, CAST(ceil(count(*) / {AR.PER_ARCHIVE}.0) AS BIGINT) AS parts,
           CAST(sum(76 + 2 * strlen(entry) + CASE WHEN ends_with(entry, '/') THEN 0 ELSE strlen(content) END) AS BIGINT) AS entry_bytes
    FROM fx_archive_entries GROUP BY repository_id, branch) t)"""


@q("scan_archive")
def scan_archive(spark, sf):
    ent = AR.expand_archives(archives_df(spark, sf), prefilter=False)
    return ent.where(~F.col("entry").endswith("/")).select(
        "repository_id", "entry", F.col("content").cast("string").alias("content"))


ORACLE["scan_archive"] = cte("fx_archive_entries") + "SELECT repository_id, entry, content FROM fx_archive_entries WHERE NOT ends_with(entry, '/')"


@q("scan_archive_files")
def scan_archive_files(spark, sf):
    """Archive bytes -> prefiltered entries -> decoded supported files (the whole archive route)."""
    files = FL.entries_to_files(AR.expand_archives(archives_df(spark, sf)))
    return files.select("repository_id", "file_path", "language", "size", "content")


ORACLE["scan_archive_files"] = FQ.FILES_SQL + "SELECT repository_id, file_path, language, size, content FROM files"


@q("scan_archive_size")
def scan_archive_size(spark, sf):
    a = AR.archive_sizes(archives_df(spark, sf))
    return a.select("repository_id", "branch", "n_archives", F.round(F.col("n_bytes") / 1024 / 1024, 6).alias("size_mb"))


ORACLE["scan_archive_size"] = cte("fx_archive_entries").rstrip() + ",\n" + archive_sql() + """
SELECT repository_id, branch, parts AS n_archives, round(n_bytes / 1024 / 1024, 6) AS size_mb FROM arch"""


def repo_sources(spark, sf, damaged=None):
    """Archives, listings and blobs; the limit is the median size of a repository's archives (one number)."""
    archives = archives_df(spark, sf, damaged)
    median = AR.archive_sizes(archives).agg(F.percentile("n_bytes", 0.5)).first()[0]
    return RepoSources(archives, trees_df(spark, sf), blobs_df(spark, sf), (median or 0) / 1024 / 1024)


@q("route_archives")
def route_archives(spark, sf):
    """F08 + U01: every requested repository read on the route that its archives' size gives."""
    requests = PQ.repo_requests_df(spark, sf)
    src = repo_sources(spark, sf)
    files, _, _ = routed_files(requests, src)
    routes = routed(requests, src).select("repository_id", "branch", "route")
    return files.join(routes, ["repository_id", "branch"]).select("repository_id", "branch", "route", "file_path", "language", "size")


def routes_sql(damaged: str = "false") -> str:
    """The files (rf) of every requested repository and branch on its route; the archive route of damaged archives gives none."""
    return FQ.FILES_SQL.replace("WITH ", "WITH " + cte("fx_tree_items")[5:] + ",\n", 1).rstrip() + f""", {archive_sql(damaged)},
routes AS (SELECT r.repository_id, r.owner, r.repo_name, r.branch, parts,
  CASE WHEN n_bytes IS NULL OR n_bytes <= (SELECT quantile_cont(n_bytes, 0.5) FROM arch) THEN 'archive' ELSE 'tree' END AS route
  FROM fx_repo_requests r LEFT JOIN arch USING (repository_id, branch)),
items AS (
  SELECT repository_id, json_extract_string(item_json, '$.path') AS path, json_extract_string(item_json, '$.type') AS type,
         url, blob_text, fault FROM fx_tree_items
), titems AS (
  SELECT *, {S.language('path')} AS language FROM items WHERE type = 'blob' AND NOT {S.hidden('path')} AND {S.language('path')} <> 'unknown'
), rf AS (
  SELECT f.repository_id, f.branch, r.owner, r.repo_name, 'archive' AS route, file_path, language, content, size
  FROM files f JOIN routes r USING (repository_id, branch) WHERE r.route = 'archive' AND NOT ({damaged.replace("repository_id", "f.repository_id")})
  UNION ALL
  SELECT t.repository_id, r.branch, r.owner, r.repo_name, 'tree', path, language, blob_text, strlen(blob_text)
  FROM titems t JOIN routes r USING (repository_id) WHERE r.route = 'tree' AND blob_text IS NOT NULL AND fault IS NULL)
"""


ORACLE["route_archives"] = routes_sql() + "SELECT repository_id, branch, route, file_path, language, size FROM rf"


TREE_SQL = cte("fx_tree_items") + f""", items AS (
  SELECT doc_id, repository_id, json_extract_string(item_json, '$.path') AS path,
         json_extract_string(item_json, '$.type') AS type, json_extract_string(item_json, '$.url') AS url, blob_text, fault
  FROM fx_tree_items
), src AS (
  SELECT *, {S.language('path')} AS language FROM items
  WHERE type = 'blob' AND NOT {S.hidden('path')} AND {S.language('path')} <> 'unknown'
)
"""


@q("scan_tree")
def scan_tree(spark, sf):
    return TR.source_items(trees_df(spark, sf)).select("repository_id", "path", "type", "url", "language")


ORACLE["scan_tree"] = TREE_SQL + "SELECT repository_id, path, type, url, language FROM src"


@q("scan_tree_entries")
def scan_tree_entries(spark, sf):
    return trees_df(spark, sf).select("repository_id", "truncated", "path", "type", "url")


ORACLE["scan_tree_entries"] = TREE_SQL + "SELECT repository_id, false AS truncated, path, type, url FROM items"


@q("scan_blob")
def scan_blob(spark, sf):
    return TR.decode_blobs(blobs_df(spark, sf)).select("url", "size", "base64", "utf8", "text")


ORACLE["scan_blob"] = cte("fx_tree_items") + """SELECT url, CASE coalesce(fault, '') WHEN 'base64' THEN NULL WHEN 'utf8' THEN 2 ELSE strlen(blob_text) END AS size,
  coalesce(fault, '') <> 'base64' AS base64, fault IS NULL AS utf8, CASE WHEN fault IS NULL THEN blob_text END AS text
FROM fx_tree_items WHERE blob_text IS NOT NULL"""


@q("join_tree_blob")
def join_tree_blob(spark, sf):
    files, _ = TR.join_blobs(TR.source_items(trees_df(spark, sf)), blobs_df(spark, sf))
    return files.select("repository_id", "file_path", "url", "language", "size", "content")


ORACLE["join_tree_blob"] = TREE_SQL + "SELECT repository_id, path AS file_path, url, language, strlen(blob_text) AS size, blob_text AS content FROM src WHERE blob_text IS NOT NULL AND fault IS NULL"


@q("rejects")
def rejects(spark, sf):
    """The dead-letter log across stages (bad archives, missing and bad blobs, unknown pulls, invalid pulls)."""
    # every archive once more, cut short
    broken = archives_df(spark, sf).withColumn("content", F.expr("substring(content, 1, 20)"))
    bad_archives = IX.rejects("archive_read", AR.archive_rejects(broken), F.concat_ws("@", "repository_id", "branch"), F.split_part("error", F.lit(":"), F.lit(1)))
    _, bad_blobs = TR.join_blobs(TR.source_items(trees_df(spark, sf)), blobs_df(spark, sf))
    nf = IX.rejects("pr_fetch", PR.not_found(PQ.pr_requests_df(spark, sf), PQ.pulls_df(spark, sf)),
                    "request_id", "pull not found")
    recs = PQ.records_df(spark, sf)
    invalid = IX.rejects("pr_validate", recs.where(~PR.is_valid(recs)), PR.pull_key(), PR.invalid_reason(recs))
    return bad_archives.unionByName(bad_blobs).unionByName(nf).unionByName(invalid)


ORACLE["rejects"] = PQ.PULLS_SQL.rstrip() + ", " + TREE_SQL[5:].rstrip() + ",\n" + cte("fx_archive_entries")[5:].rstrip() + f""",
{archive_sql()}
SELECT 'archive_read' AS stage, concat(CAST(repository_id AS VARCHAR), '@', branch) AS key, 'bad archive' AS reason
FROM arch, unnest(range(parts)) AS t(part)
UNION ALL
SELECT 'blob_fetch', url, CASE WHEN blob_text IS NULL THEN 'blob not found' WHEN fault = 'base64' THEN 'not base64' ELSE 'not utf-8' END
FROM src WHERE blob_text IS NULL OR fault IS NOT NULL
UNION ALL
{PQ.INVALID_SQL}
UNION ALL
SELECT 'pr_fetch', CAST(request_id AS VARCHAR), 'pull not found' FROM fx_pr_request_log r
WHERE NOT EXISTS (SELECT 1 FROM fx_pulls p WHERE p.repository_id = r.repository_id AND p.pr_number = r.pr_number)"""
