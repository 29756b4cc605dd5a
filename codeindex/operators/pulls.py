"""Pull requests -> flat PR documents.

Files and commits are rolled up per pull with partial (map-side) aggregation
before they meet the pulls, so the joins see one row per pull on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import patterns as P
from ..functions.times import parse_epoch


# A pull number is only known inside its repository.
KEY = ["repository_id", "pr_number"]
REQUIRED = ["pr_number", "title", "author", "created_at", "updated_at", "html_url"]


def py_strip(c: Column) -> Column:
    """Python str.strip(): remove leading/trailing Unicode whitespace."""
    ws = P.WS_CLASS_BODY
    return F.regexp_replace(c, f"^[{ws}]+|[{ws}]+$", "")


def _ordered(values: str, position: str = "position") -> Column:
    """Values of a group in position order (sorted struct list, then projected)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(position), F.col(values)))),
                       lambda x: x[values])


def file_rollup(files: DataFrame, page_limit: int | None = None) -> DataFrame:
    """Ordered file names, summed additions / deletions (missing = 0), file count.

    ``page_limit=n`` keeps only positions <= n, which mirrors rolling up the first
    listing page only; by default every landed file counts.
    """
    if page_limit:
        files = files.where(F.col("position") <= page_limit)
    return files.groupBy(*KEY).agg(
        _ordered("filename").alias("changed_files"),
        F.sum(F.coalesce("additions", F.lit(0))).alias("additions"),
        F.sum(F.coalesce("deletions", F.lit(0))).alias("deletions"),
        F.count(F.lit(1)).alias("changed_files_count"))


def commit_rollup(commits: DataFrame, page_limit: int | None = None) -> DataFrame:
    """Commit messages in order."""
    if page_limit:
        commits = commits.where(F.col("position") <= page_limit)
    return commits.groupBy(*KEY).agg(_ordered("message").alias("commit_messages"))


def flatten_pulls(pulls: DataFrame) -> DataFrame:
    """P16 + P17: nested payload -> flat pull record with epoch-second timestamps."""
    return pulls.select(
        "repository_id", F.col("number").alias("pr_number"), "title",
        F.coalesce(F.col("body"), F.lit("")).alias("body"), "state",
        F.col("user.login").alias("author"),
        parse_epoch(F.col("created_at")).alias("created_at"),
        parse_epoch(F.col("updated_at")).alias("updated_at"),
        parse_epoch(F.col("merged_at")).alias("merged_at"),
        parse_epoch(F.col("closed_at")).alias("closed_at"),
        F.coalesce(F.transform("labels", lambda x: x["name"]), F.array().cast("array<string>")).alias("labels"),
        F.col("milestone.title").alias("milestone"),
        "html_url")


def search_text(title: Column, body: Column, messages: Column) -> Column:
    """P15 + F09: '[Title] t', '[Body]\\n' + stripped body, '[Commits]\\n- m' lines; blank sections left out."""
    t = F.when(title.isNotNull() & (title != ""), F.concat(F.lit("[Title] "), title))
    b_s = py_strip(body)
    b = F.when(body.isNotNull() & (b_s != ""), F.concat(F.lit("[Body]\n"), b_s))
    kept = F.filter(messages, lambda m: py_strip(m) != "")
    lines = F.array_join(F.transform(kept, lambda m: F.concat(F.lit("- "), py_strip(m))), "\n")
    c = F.when(F.size(messages) > 0, F.concat(F.lit("[Commits]\n"), lines))
    return F.concat_ws("\n\n", t, b, c)


def pull_records(pulls: DataFrame, files: DataFrame, commits: DataFrame,
                 page_limit: int | None = None) -> DataFrame:
    """Pull ⟕ files rollup ⟕ commits rollup, missing rollups as empty / zero."""
    flat = flatten_pulls(pulls)
    fr = file_rollup(files, page_limit)
    cr = commit_rollup(commits, page_limit)
    empty = F.array().cast("array<string>")
    return (flat.join(fr, KEY, "left").join(cr, KEY, "left")
                .withColumn("changed_files", F.coalesce("changed_files", empty))
                .withColumn("additions", F.coalesce("additions", F.lit(0)).cast("long"))
                .withColumn("deletions", F.coalesce("deletions", F.lit(0)).cast("long"))
                .withColumn("changed_files_count", F.coalesce("changed_files_count", F.lit(0)).cast("long"))
                .withColumn("commit_messages", F.coalesce("commit_messages", empty)))


def is_valid(df: DataFrame) -> Column:
    """state open/closed and every required field present (never null)."""
    ok = F.col("state").isNotNull() & F.col("state").isin("open", "closed")
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    return ok


def invalid_reason(df: DataFrame) -> Column:
    r = F.when(~F.col("state").isin("open", "closed") | F.col("state").isNull(), F.lit("invalid state"))
    for c in REQUIRED:
        r = r.when(F.col(c).isNull(), F.lit(f"missing {c}"))
    return r


def pr_documents(requests: DataFrame, records: DataFrame) -> DataFrame:
    """One document per (request, found pull); repository context comes from the request."""
    req = requests.select("repository_id", "owner", "repo_name", "branch", "pr_number")
    j = req.join(records, KEY)
    return j.select(
        C.pr_doc_id(F.col("pr_number"), F.col("repository_id")).alias("id"),
        F.lit(1).alias("sourceType"), "pr_number", "title", "state", "author", "created_at", "updated_at",
        "merged_at", "closed_at", "body", "commit_messages", "changed_files", "additions", "deletions",
        "changed_files_count", "labels", "milestone", "repository_id", "owner", "repo_name", "branch",
        C.source_label(F.col("repo_name"), F.col("branch")).alias("source"), "html_url",
        C.index_name(F.col("repo_name"), F.col("branch"), "_pr").alias("index_name"),
        search_text(F.col("title"), F.col("body"), F.col("commit_messages")).alias("search_text"))


def pull_key() -> Column:
    """A pull's name in the reject log."""
    return F.concat_ws("#", "repository_id", "pr_number")


def not_found(requests: DataFrame, pulls: DataFrame) -> DataFrame:
    """Requests naming a pull that does not exist (dropped, not retried)."""
    return requests.join(pulls.select("repository_id", F.col("number").alias("pr_number")), KEY, "left_anti")


def summary(docs: DataFrame) -> Column:
    """P20 + A07: the multi-line PR summary."""
    return F.format_string("PR #%d: %s\n  Author: %s\n  State: %s\n  Files: %d (+%d/-%d)\n  Commits: %d",
                           F.col("pr_number"), F.col("title"), F.col("author"), F.col("state"),
                           F.col("changed_files_count"), F.col("additions"), F.col("deletions"),
                           F.size("commit_messages"))
