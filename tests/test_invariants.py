"""Cross-cutting invariants: stream result = batch result, index tables keep the newest versions."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_repo_stream_equals_batch(spark):
    import __spark_entry__ as E
    from codeindex.operators import documents, files as FL
    from codeindex.plans import pr_queries as PQ, source_queries as SQ, stream_queries as STQ
    from codeindex.streaming.sync import routed_files
    requests = PQ.repo_requests_df(spark, SF_SMALL)
    files, _, held = routed_files(requests, SQ.repo_sources(spark, SF_SMALL, STQ.DAMAGED))
    docs = documents.code_documents(FL.attach_requests(files, requests))
    batch = {(r.index_name, r.id, r.text) for r in docs.collect()}
    stream = {(r.index_name, r.id, r.text) for r in E.queries()["stream_repo_sync"](spark, SF_SMALL).collect()}
    assert batch == stream and batch
    for h in held:
        h.unpersist()


def test_doc_ids_unique_per_index(spark):
    import __spark_entry__ as E
    d = E.queries()["pr_documents"](spark, SF_SMALL)
    assert d.groupBy("index_name", "id").count().where(F.col("count") > 1).count() == 0


def test_route_limit_zero_means_default_and_equality_allowed(spark):
    from codeindex.operators.routing import route_repositories
    mb = 1024 * 1024
    sizes = spark.createDataFrame([(1, None), (2, 50 * mb), (3, 50 * mb + 1)], "repository_id long, n_bytes long")
    got = {r.repository_id: r.route for r in route_repositories(sizes, 0).collect()}
    assert got == {1: "archive", 2: "archive", 3: "tree"}


def test_runs_never_replace_each_other(spark):
    from codeindex.operators.index import IndexTable
    from codeindex.session import new_path
    t = IndexTable(spark, new_path(spark, "runs"))
    one, two = t.run_of(new_path(spark, "ckpt-a")), t.run_of(new_path(spark, "ckpt-b"))
    schema = "index_name string, id string, v long"
    t.write_batch(spark.createDataFrame([("i", "a", 1), ("i", "b", 1)], schema), 0, run_no=one)
    t.write_batch(spark.createDataFrame([("i", "a", 2), ("i", "c", 2)], schema), 0, run_no=two)
    assert one < two and sorted((r.id, r.v) for r in t.read().collect()) == [("a", 2), ("b", 1), ("c", 2)]


def test_run_survives_a_restart(spark):
    from codeindex.operators.index import IndexTable
    from codeindex.session import new_path
    root, checkpoint = new_path(spark, "runs"), new_path(spark, "ckpt")
    first = IndexTable(spark, root).run_of(checkpoint)
    assert IndexTable(spark, root).run_of(checkpoint) == first
    assert IndexTable(spark, root).run_of(new_path(spark, "ckpt")) == first + 1


def test_two_branches_of_a_repository_keep_their_files_apart(spark):
    from codeindex.operators.files import attach_requests
    files = spark.createDataFrame([(1, "main", "a.py"), (1, "dev", "a.py"), (2, None, "b.py")], "repository_id long, branch string, file_path string")
    requests = spark.createDataFrame([(1, "o", "r", "main"), (1, "o", "r", "dev"), (2, "o", "s", None)],
                                     "repository_id long, owner string, repo_name string, branch string")
    got = sorted((r.repository_id, r.branch, r.file_path) for r in attach_requests(files, requests).collect())
    assert got == [(1, "dev", "a.py"), (1, "main", "a.py"), (2, "main", "b.py")]


def test_pull_numbers_are_known_inside_their_repository(spark):
    import __spark_entry__ as E
    d = E.queries()["pr_documents"](spark, SF_SMALL)
    wrong = d.where(~F.col("html_url").contains(F.concat(F.lit("/"), F.col("repo_name"), F.lit("/pull/"))))
    assert d.count() > 0 and wrong.count() == 0
    assert d.groupBy("pr_number").agg(F.countDistinct("repository_id").alias("n")).where("n > 1").count() > 0


def test_vector_search_takes_any_number_of_queries_in_blocks(spark):
    from codeindex.operators import search as SR
    rng = __import__("numpy").random.default_rng(3)
    corpus = spark.createDataFrame([(i, rng.normal(size=3072).tolist()) for i in range(40)], "doc_id long, embedding array<float>")
    qs = corpus.select(F.col("doc_id").alias("query_id"), "embedding")
    whole = sorted(tuple(r) for r in SR.search_vector(corpus, qs, k=3).collect())
    from codeindex.operators import vectors as V
    kept = V.BLOCK_ROWS, V.QUERY_ROWS
    V.BLOCK_ROWS, V.QUERY_ROWS = 7, 3
    try:
        blocks = sorted(tuple(r) for r in SR.search_vector(corpus, qs, k=3).collect())
    finally:
        V.BLOCK_ROWS, V.QUERY_ROWS = kept
    assert whole == blocks and len(whole) == 120 and all(r[1] == r[0] for r in whole if r[3] == 1)


def test_search_modes_filter_before_ranking(spark):
    from codeindex.operators import search as SR
    docs = spark.createDataFrame([("a", "alpha beta", "x", "open", {"default": [1.0, 0.0]}), ("b", "alpha", "x", "closed", {"default": [0.9, 0.1]}),
                                  ("c", "beta gamma", "alpha", "closed", {"default": [0.0, 1.0]})],
                                 "id string, title string, body string, state string, _vectors map<string, array<float>>")
    docs = docs.withColumn("commit_messages", F.array(F.lit("fix"))).withColumn("changed_files", F.array(F.lit("src/a.py")))
    qs = spark.createDataFrame([(1, "alpha", [1.0, 0.0])], "query_id long, q string, embedding array<float>")
    found = {m: [r.id for r in SR.search(docs, "pr", qs, mode=m, where={"state": "closed"}, k=2).orderBy("rank").collect()]
             for m in ("keyword", "vector", "hybrid")}
    assert set(found["keyword"]) == {"b", "c"} and found["vector"] == ["b", "c"] and found["hybrid"][0] == "b"
    assert [r.id for r in SR.search(docs, "pr", mode="filter", where={"state": "closed"}).collect()] == ["b", "c"]
    many = spark.range(60).select(F.col("id").cast("string").alias("id"), F.lit("closed").alias("state"))
    assert SR.search(many, "pr", mode="filter", where={"state": "closed"}).count() == 60


def test_filter_search_takes_several_conditions_and_no_limit(spark):
    from codeindex.operators.search import filter_search
    docs = spark.createDataFrame([(str(i), ["x", "y"] if i % 2 else ["x"], i) for i in range(60)], "id string, labels array<string>, additions long")
    assert filter_search(docs, "pr", {"labels": [("has", "x"), ("has", "y")], "additions": [("range", 10, None), ("in", [11, 12, 13])]}).count() == 2
    assert filter_search(docs, "pr", {"labels": ("has", "x")}).count() == 60


def test_newest_version_wins_without_moving_documents(spark):
    from codeindex.operators.index import IndexTable
    from codeindex.session import new_path
    t = IndexTable(spark, new_path(spark, "versions"))
    schema = "index_name string, id string, v long, wide string"
    for run, batch, rows in [(1, 1, [("i", "a", 1), ("i", "b", 1), ("7", "a", 1)]), (1, 2, [("i", "a", 2), ("i", "c", 5), ("i", "c", 5), ("i", "c", 5)]),
                             (2, 0, [("j", "a", 3), ("i", "b", 9)]), (1, 3, [("i", "b", 4)])]:
        t.write_batch(spark.createDataFrame([(*r, "x" * 100) for r in rows], schema), batch, run_no=run)
    got = sorted(tuple(r) for r in t.read().select("index_name", "id", "v").collect())
    assert got == [("7", "a", 1), ("i", "a", 2), ("i", "b", 9), ("i", "c", 5), ("j", "a", 3)]
    t.write_batch(spark.createDataFrame([("i", "a", 6, "y")], schema), 2, run_no=1)  # the batch once more, with other rows
    df = t.read("i")
    assert sorted(tuple(r) for r in df.select("id", "v").collect()) == [("a", 6), ("b", 9)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.find("Initial Plan")]
    # the wide column is in no exchange: one scan of keys is shuffled, the rows meet it as a broadcast
    assert "BroadcastHashJoin" in plan and plan.count("ReadSchema: struct<id:string,v:bigint,wide:string") == 1
    assert not t.write_batch(df.limit(0).withColumn("index_name", F.lit("i")), 9)


def test_batches_may_gain_columns_and_empty_tables_raise(spark):
    import pytest
    from codeindex.operators.index import IndexTable
    from codeindex.session import new_path
    t = IndexTable(spark, new_path(spark, "columns"))
    with pytest.raises(FileNotFoundError):
        t.read()
    empty = spark.createDataFrame([], "index_name string, id string")
    t.write_batch(empty, 1, check_empty=False)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.write_batch(spark.createDataFrame([("i", "a")], "index_name string, id string"), 2)
    t.write_batch(spark.createDataFrame([("i", "b", 2)], "index_name string, id string, n long"), 1, run_no=3)
    assert sorted((r.id, r.n) for r in t.read().collect()) == [("a", None), ("b", 2)]
