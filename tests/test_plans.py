"""Plan-shape checks: the physical properties the operators are designed around."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


@pytest.fixture
def long_plans(spark):
    """Plans are shown with whole lists of pushed and partition filters."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_top_k_limits_before_the_shuffle(spark):
    import __spark_entry__ as E
    df = E.queries()["search_keyword"](spark, SF_SMALL)
    df.collect()
    plan = plan_of(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_code_documents_one_python_step_after_rebalance(spark):
    import __spark_entry__ as E
    plan = plan_of(E.queries()["code_documents"](spark, SF_SMALL))
    assert plan.count("ArrowEvalPython") == 1
    assert "REBALANCE_PARTITIONS" in plan
    assert "BroadcastHashJoin" in plan  # language lookup and request side


def test_pull_validity_filter_reaches_the_json_scan(spark):
    from codeindex.plans import pr_queries as PQ
    from codeindex.operators import pulls as PR
    recs = PQ.records_df(spark, SF_SMALL)
    fmt = recs.where(PR.is_valid(recs))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PushedFilters: \[[^\n]*In\(state, \[closed,open\]\)", fmt)


def test_stream_batch_prunes_payload_partitions(spark):
    from codeindex.plans import pr_queries as PQ, stream_queries as STQ
    from codeindex.streaming import sync
    src = STQ._sources(spark, SF_SMALL)
    batch = PQ.pr_requests_df(spark, SF_SMALL).where(F.col("request_id") % 4 == 0)
    docs, _, held = sync.pr_batch(batch, src, 64)
    docs.write.format("noop").mode("overwrite").save()
    assert "dynamicpruningexpression(pr_bucket" in plan_of(docs)
    for h in held:
        h.unpersist()


def test_keyword_search_reads_only_folders_of_its_tokens(spark, long_plans):
    from codeindex.operators.keyword import KeywordIndex, _held
    docs = spark.createDataFrame([(i, f"word{i % 50} common " + "rare " * (i == 3)) for i in range(400)], "doc_id long, text string")
    index = KeywordIndex.build(docs, "doc_id", {"text": F.col("text")})
    qs = spark.createDataFrame([(1, "rare word7")], "query_id long, q string")
    terms = _held(index.query_terms(qs, "query_id", "q", 10), "terms")
    found = index.scores(terms, "query_id")
    found.collect()
    plan = plan_of(found)
    assert "dynamicpruningexpression(bucket" in plan and "dynamicpruningexpression(tier" in plan


def test_repository_batch_opens_only_its_archives_within_the_limit(spark, long_plans):
    from codeindex.plans import pr_queries as PQ, source_queries as SQ
    from codeindex.streaming import sync
    src = SQ.repo_sources(spark, SF_SMALL)
    batch = PQ.repo_requests_df(spark, SF_SMALL).where(F.col("repository_id") < 3)
    files, _, held = sync.routed_files(batch, src)
    files.collect()
    # the held entries are one scan of archives; the listings and blobs stand in the plan itself
    entries = held[1]._jdf.queryExecution().toString()
    assert "dynamicpruning" in entries and "LessThanOrEqual(length" in entries
    assert "dynamicpruning" in plan_of(files)
    sizes = src.archives.select("repository_id", "branch", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in sizes
    for h in held:
        h.unpersist()
