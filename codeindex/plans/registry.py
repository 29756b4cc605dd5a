"""All registered queries and their oracle SQL."""

from __future__ import annotations

from ..session import ship_package, sized_shuffles
from . import files_queries, index_queries, pr_queries, source_queries, stream_queries

_MODULES = [files_queries, pr_queries, index_queries, source_queries, stream_queries]


def _shipped(fn):
    def run(spark, sf_dir):
        ship_package(spark)
        sized_shuffles(spark, sf_dir)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update({k: _shipped(v) for k, v in m.QUERIES.items()})
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out


def prepare(spark, sf_dir: str) -> None:
    """Land the fixture-derived source files the registered queries read (idempotent per session)."""
    from . import index_queries as IQ
    from . import pr_queries as PQ
    from . import source_queries as SQ
    from . import stream_queries as STQ
    for fn in (PQ.pulls_df, PQ.pull_files_df, PQ.pull_commits_df, PQ.pr_requests_df, PQ.repo_requests_df,
               SQ.archives_df, SQ.trees_df, SQ.blobs_df, STQ._pr_request_dir, STQ._repo_request_dir,
               STQ._sources, IQ.keyword_index, IQ.vector_index, IQ.text_vector_index):
        fn(spark, sf_dir)
