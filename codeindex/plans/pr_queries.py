"""Registered queries: request sources, pull payloads, rollups, PR documents (step 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pulls as PR
from ..sources import pulls as SP
from ..sources import requests as RQ
from ..sources.fixtures import cte, fixture
from ..sources.landing import landed
from . import sqlbits as S

QUERIES: dict = {}
ORACLE: dict = {}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- landed sources ----------------------------------------------------------

def pulls_df(spark, sf):
    path = landed(spark, sf, "pulls", lambda: SP.pulls_payload(fixture(spark, sf, "fx_pulls")), packed=True)
    return SP.read_pulls(spark, path)


def pull_files_df(spark, sf):
    path = landed(spark, sf, "pull_files", lambda: SP.pull_files_payload(fixture(spark, sf, "fx_pull_files")), packed=True)
    return SP.read_pull_files(spark, path)


def pull_commits_df(spark, sf):
    path = landed(spark, sf, "pull_commits",
                  lambda: SP.pull_commits_payload(fixture(spark, sf, "fx_pull_commits")), packed=True)
    return SP.read_pull_commits(spark, path)


def pr_requests_df(spark, sf):
    path = landed(spark, sf, "pr_requests", lambda: fixture(spark, sf, "fx_pr_request_log"), fmt="parquet")
    return RQ.read_pr_requests(spark, path, fmt="parquet")


def repo_requests_df(spark, sf):
    path = landed(spark, sf, "repo_requests", lambda: fixture(spark, sf, "fx_repo_requests"))
    return RQ.read_repo_requests(spark, path)


def records_df(spark, sf):
    return PR.pull_records(pulls_df(spark, sf), pull_files_df(spark, sf), pull_commits_df(spark, sf))


def distinct_requests(spark, sf):
    return pr_requests_df(spark, sf).select("repository_id", "owner", "repo_name", "branch", "pr_number").distinct()


def pr_docs_df(spark, sf):
    recs = records_df(spark, sf)
    return PR.pr_documents(distinct_requests(spark, sf), recs.where(PR.is_valid(recs)))


def joined_arrays(df):
    """Arrays as joined strings, for comparison."""
    out = df
    for c, sep in (("changed_files", "|"), ("labels", "|"), ("commit_messages", "\n")):
        if c in df.columns:
            out = out.withColumn(c, F.array_join(c, sep))
    return out


# ---- oracle building blocks ----------------------------------------------------

PULLS_SQL = cte("fx_pulls", "fx_pull_files", "fx_pull_commits", "fx_pr_request_log") + f""", pulls AS (
  SELECT repository_id, pr_number, title, coalesce(body, '') AS body, body AS raw_body, state,
         json_extract_string(payload, '$.user.login') AS author,
         {S.epoch('created_at')} AS created_at, {S.epoch('created_at')} AS updated_at,
         CAST(NULL AS BIGINT) AS merged_at, {S.epoch('closed_at')} AS closed_at,
         array_to_string(coalesce(json_extract_string(payload, '$.labels[*].name'), []), '|') AS labels,
         json_extract_string(payload, '$.milestone.title') AS milestone,
         concat('https://github.com/org', CAST(repository_id % 5 AS VARCHAR), '/repo-', CAST(repository_id AS VARCHAR),
                '.x/pull/', CAST(pr_number AS VARCHAR)) AS html_url
  FROM fx_pulls
), fr AS (
  SELECT repository_id, pr_number, string_agg(filename, '|' ORDER BY position) AS changed_files,
         sum(coalesce(additions, 0)) AS additions, sum(coalesce(deletions, 0)) AS deletions,
         count(*) AS changed_files_count
  FROM fx_pull_files GROUP BY repository_id, pr_number
), cr AS (
  SELECT repository_id, pr_number, string_agg(message, chr(10) ORDER BY position) AS commit_messages, count(*) AS n_commits,
         string_agg('- ' || {S.py_strip('message')}, chr(10) ORDER BY position)
           FILTER (WHERE {S.py_strip('message')} <> '') AS commit_lines
  FROM fx_pull_commits GROUP BY repository_id, pr_number
), recs AS (
  SELECT p.*, coalesce(fr.changed_files, '') AS changed_files, coalesce(fr.additions, 0) AS additions,
         coalesce(fr.deletions, 0) AS deletions, coalesce(fr.changed_files_count, 0) AS changed_files_count,
         coalesce(cr.commit_messages, '') AS commit_messages, coalesce(cr.n_commits, 0) AS n_commits,
         concat_ws(chr(10) || chr(10),
           CASE WHEN p.title IS NOT NULL AND p.title <> '' THEN '[Title] ' || p.title END,
           CASE WHEN {S.py_strip('p.body')} <> '' THEN '[Body]' || chr(10) || {S.py_strip('p.body')} END,
           CASE WHEN coalesce(cr.n_commits, 0) > 0 THEN '[Commits]' || chr(10) || coalesce(cr.commit_lines, '') END
         ) AS search_text
  FROM pulls p LEFT JOIN fr USING (repository_id, pr_number) LEFT JOIN cr USING (repository_id, pr_number)
), reqs AS (
  SELECT DISTINCT repository_id, owner, repo_name, branch, pr_number FROM fx_pr_request_log
), docs AS (
  SELECT {S.pr_doc_id('r.pr_number', 'r.repository_id')} AS id, 1 AS sourceType, r.pr_number, title, state, author,
         created_at, updated_at, merged_at, closed_at, body, commit_messages, changed_files, additions, deletions,
         changed_files_count, labels, milestone, r.repository_id, r.owner, r.repo_name, r.branch,
         concat(r.repo_name, '@', r.branch) AS source, html_url,
         {S.index_name('r.repo_name', 'r.branch', '_pr')} AS index_name, search_text, n_commits
  FROM reqs r JOIN recs USING (repository_id, pr_number)
  WHERE state IN ('open', 'closed') AND title IS NOT NULL AND author IS NOT NULL AND created_at IS NOT NULL
    AND updated_at IS NOT NULL AND html_url IS NOT NULL
)
"""


# The reject rows of invalid pulls (first failing rule), on top of PULLS_SQL.
INVALID_SQL = """SELECT 'pr_validate' AS stage, concat(CAST(repository_id AS VARCHAR), '#', CAST(pr_number AS VARCHAR)) AS key,
  CASE WHEN coalesce(state, '') NOT IN ('open', 'closed') THEN 'invalid state' WHEN title IS NULL THEN 'missing title' WHEN author IS NULL THEN 'missing author'
       WHEN created_at IS NULL THEN 'missing created_at' WHEN updated_at IS NULL THEN 'missing updated_at' ELSE 'missing html_url' END AS reason
FROM recs WHERE (coalesce(state, '') NOT IN ('open', 'closed') OR title IS NULL OR author IS NULL OR created_at IS NULL OR updated_at IS NULL OR html_url IS NULL)"""


# ---- sources -------------------------------------------------------------------

@q("src_repo_requests")
def src_repo_requests(spark, sf):
    return repo_requests_df(spark, sf)


ORACLE["src_repo_requests"] = cte("fx_repo_requests") + "SELECT repository_id, owner, repo_name, coalesce(branch, 'main') AS branch FROM fx_repo_requests"


@q("src_pr_requests")
def src_pr_requests(spark, sf):
    return pr_requests_df(spark, sf).select("request_id", "repository_id", "owner", "repo_name", "branch",
                                            "pr_number")


ORACLE["src_pr_requests"] = cte("fx_pr_request_log") + "SELECT request_id, repository_id, owner, repo_name, branch, pr_number FROM fx_pr_request_log"


@q("src_issue_requests")
def src_issue_requests(spark, sf):
    """Issue requests land as a table (no consumer exists for them)."""
    def build():
        r = fixture(spark, sf, "fx_pr_request_log")
        return r.select("repository_id", "owner", "repo_name", F.col("pr_number").alias("issue_number"))
    path = landed(spark, sf, "issue_requests", build)
    return RQ.read_issue_requests(spark, path)


ORACLE["src_issue_requests"] = cte("fx_pr_request_log") + "SELECT repository_id, owner, repo_name, pr_number AS issue_number FROM fx_pr_request_log"


@q("scan_pull")
def scan_pull(spark, sf):
    p = pulls_df(spark, sf)
    return p.select("repository_id", F.col("number").alias("pr_number"), "title", "body", "state",
                    F.col("user.login").alias("author"),
                    F.array_join(F.transform("labels", lambda x: x["name"]), "|").alias("labels"),
                    F.col("milestone.title").alias("milestone"), "created_at", "closed_at")


ORACLE["scan_pull"] = cte("fx_pulls") + """SELECT repository_id, pr_number, title, body, state, json_extract_string(payload, '$.user.login') AS author,
  array_to_string(coalesce(json_extract_string(payload, '$.labels[*].name'), []), '|') AS labels,
  json_extract_string(payload, '$.milestone.title') AS milestone, created_at, closed_at FROM fx_pulls"""


@q("scan_pull_files")
def scan_pull_files(spark, sf):
    return pull_files_df(spark, sf)


ORACLE["scan_pull_files"] = cte("fx_pull_files") + "SELECT repository_id, pr_number, position, filename, additions, deletions FROM fx_pull_files"


@q("scan_pull_commits")
def scan_pull_commits(spark, sf):
    return pull_commits_df(spark, sf)


ORACLE["scan_pull_commits"] = cte("fx_pull_commits") + """SELECT repository_id, pr_number,
  row_number() OVER (PARTITION BY repository_id, pr_number ORDER BY position) AS position, message FROM fx_pull_commits"""


# ---- rollups and projections ---------------------------------------------------

@q("pr_file_rollup")
def pr_file_rollup(spark, sf):
    return joined_arrays(PR.file_rollup(pull_files_df(spark, sf)))


ORACLE["pr_file_rollup"] = PULLS_SQL + "SELECT repository_id, pr_number, changed_files, additions, deletions, changed_files_count FROM fr"


@q("pr_commit_rollup")
def pr_commit_rollup(spark, sf):
    r = PR.commit_rollup(pull_commits_df(spark, sf))
    return joined_arrays(r.withColumn("n_commits", F.size("commit_messages")))


ORACLE["pr_commit_rollup"] = PULLS_SQL + "SELECT repository_id, pr_number, commit_messages, n_commits FROM cr"


@q("parse_epoch")
def parse_epoch_q(spark, sf):
    f = PR.flatten_pulls(pulls_df(spark, sf))
    return f.select("repository_id", "pr_number", "created_at", "updated_at", "merged_at", "closed_at")


ORACLE["parse_epoch"] = PULLS_SQL + "SELECT repository_id, pr_number, created_at, updated_at, merged_at, closed_at FROM pulls"


@q("pr_flatten")
def pr_flatten(spark, sf):
    f = PR.flatten_pulls(pulls_df(spark, sf))
    return joined_arrays(f.select("repository_id", "pr_number", "title", "body", "state", "author", "labels", "milestone",
                                  "html_url"))


ORACLE["pr_flatten"] = PULLS_SQL + "SELECT repository_id, pr_number, title, body, state, author, labels, milestone, html_url FROM pulls"


@q("pr_search_text")
def pr_search_text(spark, sf):
    r = records_df(spark, sf)
    return r.select("repository_id", "pr_number", PR.search_text(F.col("title"), F.col("body"), F.col("commit_messages"))
                    .alias("search_text"))


ORACLE["pr_search_text"] = PULLS_SQL + "SELECT repository_id, pr_number, search_text FROM recs"


@q("pr_valid")
def pr_valid(spark, sf):
    r = records_df(spark, sf)
    return r.select("repository_id", "pr_number", PR.is_valid(r).alias("valid"))


ORACLE["pr_valid"] = PULLS_SQL + """SELECT repository_id, pr_number, (coalesce(state, '') IN ('open', 'closed') AND title IS NOT NULL AND author IS NOT NULL
  AND created_at IS NOT NULL AND updated_at IS NOT NULL AND html_url IS NOT NULL) AS valid FROM recs"""


@q("pr_documents")
def pr_documents(spark, sf):
    return joined_arrays(pr_docs_df(spark, sf))


ORACLE["pr_documents"] = PULLS_SQL + """SELECT id, sourceType, pr_number, title, state, author, created_at, updated_at, merged_at,
  closed_at, body, commit_messages, changed_files, additions, deletions, changed_files_count, labels, milestone,
  repository_id, owner, repo_name, branch, source, html_url, index_name, search_text FROM docs"""


@q("pr_doc_ids")
def pr_doc_ids(spark, sf):
    return pr_docs_df(spark, sf).select("id", "repository_id", "pr_number")


ORACLE["pr_doc_ids"] = PULLS_SQL + "SELECT id, repository_id, pr_number FROM docs"


@q("pr_summary")
def pr_summary(spark, sf):
    d = pr_docs_df(spark, sf)
    return d.select("id", PR.summary(d).alias("summary"), F.size("commit_messages").alias("n_commits"),
                    "changed_files_count")


ORACLE["pr_summary"] = PULLS_SQL + """SELECT id, concat('PR #', CAST(pr_number AS VARCHAR), ': ', title, chr(10), '  Author: ', author, chr(10),
  '  State: ', state, chr(10), '  Files: ', CAST(changed_files_count AS VARCHAR), ' (+', CAST(additions AS VARCHAR),
  '/-', CAST(deletions AS VARCHAR), ')', chr(10), '  Commits: ', CAST(n_commits AS VARCHAR)) AS summary,
  n_commits, changed_files_count FROM docs"""


@q("pr_not_found")
def pr_not_found(spark, sf):
    nf = PR.not_found(pr_requests_df(spark, sf), pulls_df(spark, sf))
    return nf.select("request_id", "repository_id", "pr_number")


ORACLE["pr_not_found"] = PULLS_SQL + """SELECT request_id, repository_id, pr_number FROM fx_pr_request_log r
WHERE NOT EXISTS (SELECT 1 FROM fx_pulls p WHERE p.repository_id = r.repository_id AND p.pr_number = r.pr_number)"""
