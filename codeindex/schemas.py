"""Declared schemas: requests, landed payloads, documents."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


REPO_REQUEST = T.StructType([
    _f("repository_id", L), _f("owner", S), _f("repo_name", S), _f("branch", S), _f("github_token", S),
])

PR_REQUEST = T.StructType([
    _f("request_id", L), _f("requested_at", T.TimestampNTZType()),
    _f("repository_id", L), _f("owner", S), _f("repo_name", S), _f("branch", S), _f("pr_number", L),
    _f("github_token", S),
])

ISSUE_REQUEST = T.StructType([
    _f("repository_id", L), _f("owner", S), _f("repo_name", S), _f("issue_number", L), _f("github_token", S),
])

# Pull payload as landed from the pulls endpoint (only the fields that are used). Payloads are fetched per
# repository, which the landing job writes beside them: a pull is known by (repository_id, number).
PULL = T.StructType([
    _f("repository_id", L), _f("number", L), _f("title", S), _f("body", S), _f("state", S),
    _f("created_at", S), _f("updated_at", S), _f("closed_at", S), _f("merged_at", S), _f("html_url", S),
    _f("user", T.StructType([_f("login", S)])),
    _f("labels", T.ArrayType(T.StructType([_f("name", S)]))),
    _f("milestone", T.StructType([_f("title", S)])),
])

# Nested part of the pull fixture's payload column.
PULL_EXTRAS = T.StructType([
    _f("user", T.StructType([_f("login", S)])),
    _f("labels", T.ArrayType(T.StructType([_f("name", S)]))),
    _f("milestone", T.StructType([_f("title", S)])),
])

# One landed document per pull for the files and commits endpoints.
PULL_FILES = T.StructType([
    _f("repository_id", L), _f("pr_number", L),
    _f("files", T.ArrayType(T.StructType([_f("filename", S), _f("additions", L), _f("deletions", L)]))),
])
PULL_COMMITS = T.StructType([
    _f("repository_id", L), _f("pr_number", L),
    _f("commits", T.ArrayType(T.StructType([_f("commit", T.StructType([_f("message", S)]))]))),
])

TREE_ITEM = T.StructType([_f("path", S), _f("type", S), _f("url", S)])
TREE = T.StructType([
    _f("repository_id", L), _f("truncated", T.BooleanType()), _f("tree", T.ArrayType(TREE_ITEM)),
])
BLOB = T.StructType([_f("url", S), _f("encoding", S), _f("content", S)])
