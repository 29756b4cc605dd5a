"""What bounds the share of a task or a worker, so that it does not grow with the tables."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_chunk_workers_get_bounded_batches(spark):
    from codeindex.operators import chunking
    before = spark.conf.get(BATCH)
    try:
        spark.conf.set(BATCH, "10000")
        files = spark.createDataFrame([("word " * 300, "python"), ("x" * 20, None), (" ", "go"), (None, "go")], "content string, language string")
        got = chunking.chunk_files(files).select("route", "chunk_raw", "chunk_error").collect()
        assert int(spark.conf.get(BATCH)) <= 1000
        assert {r.route for r in got} == {"split", "whole"} and all(r.chunk_error is None for r in got)
        assert "".join("".join(r.chunk_raw.split()) for r in got if r.route == "split") == "word" * 300
    finally:
        spark.conf.set(BATCH, before)


def test_worker_slices_hold_every_row_once():
    from codeindex.operators import chunking
    big = chunking.SLICE_CHARS
    assert list(chunking._slices([1, big, 2, 3, 0])) == [(0, 1), (1, 2), (2, 5)]
    assert list(chunking._slices([])) == [(0, 0)]


def test_dense_and_sparse_embeddings_agree_and_the_texts_are_spread(spark):
    import __spark_entry__ as E
    from codeindex.operators import embed as EM
    random.seed(3)
    rows = [(i, " ".join(random.choices(["Ärger", "b_1", "ß", "word", "日本", "x"], k=i % 7))) for i in range(40)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    for dim in (5, 3072):
        dense = {r.id: list(r.embedding) for r in EM.hash_embed(docs, "id", "text", dim).collect()}
        sparse = {(r.id, r.bucket): r.weight for r in EM.hash_weights(docs, "id", "text", dim).collect()}
        assert {(i, b): int(w) for i, v in dense.items() for b, w in enumerate(v) if w} == sparse
        assert all(len(v) == dim for v in dense.values()) and len(dense) == len(rows)
    assert "REBALANCE" in E.queries()["embed_hash"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_tasks_count_the_tokens_of_bounded_texts(spark, monkeypatch):
    from codeindex.operators import keyword as KW
    monkeypatch.setattr(KW, "TASK_BYTES", 100)
    rows = [(i, f"a{i} b b") for i in range(1000)] + [(None, "n n"), (5, None), (7, "a7 b b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = KW.token_counts(docs, "doc_id", [F.col("text")])
    assert counts.rdd.getNumPartitions() >= 70
    got = {(r.doc_id, r.token): (r.dl, r.tf_0) for r in counts.collect()}
    assert got[7, "b"] == (3, 4) and got[8, "b"] == (3, 2) and got[None, "n"] == (2, 2) and len(got) == 2001


def test_shuffles_start_from_partitions_of_the_tables_size(spark, monkeypatch):
    from codeindex import session
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.sized_shuffles(spark, SF_SMALL)
        assert spark.conf.get(name) == spark.conf.get("spark.sql.shuffle.partitions")
        monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
        session.sized_shuffles(spark, SF_SMALL)
        assert int(spark.conf.get(name)) > 500
    finally:
        spark.conf.unset(name)


def test_stream_tells_requests_apart_before_they_meet_the_documents(spark):
    from codeindex.plans import pr_queries as PQ
    from codeindex.streaming import sync
    src = sync.PullSources(PQ.pulls_df(spark, SF_SMALL), PQ.pull_files_df(spark, SF_SMALL), PQ.pull_commits_df(spark, SF_SMALL))
    log = PQ.pr_requests_df(spark, SF_SMALL)
    batch = log.unionByName(log).unionByName(log.withColumn("owner", F.lit("another")))
    docs, _, held = sync.pr_batch(batch, src, 8)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Aggregate" in x and "search_text" in x for x in plan.splitlines())
    keys = [(r.index_name, r.id) for r in docs.select("index_name", "id").collect()]
    assert len(keys) == len(set(keys)) == PQ.pr_docs_df(spark, SF_SMALL).select("index_name", "id").distinct().count()
    # a pull that has landed twice is one document still
    src.pulls = src.pulls.unionByName(src.pulls)
    again, _, more = sync.pr_batch(batch, src, 8)
    assert sorted(keys) == sorted((r.index_name, r.id) for r in again.select("index_name", "id").collect())
    for h in [*held, *more]:
        h.unpersist()


def test_keyword_search_in_blocks_and_groups_is_exact(spark, monkeypatch):
    """postings meet the queries in blocks of documents; first blocks raise the floors of the others."""
    import math
    import random
    from codeindex.operators import keyword as KW
    random.seed(3)
    words = [f"w{i}" for i in range(30)]
    texts = [random.choices(words, weights=[1 / (k + 1) for k in range(30)], k=random.randint(0, 20)) for _ in range(200)]
    texts[50:90] = [["w1", "w2"]] * 40  # equal scores
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    asked = ["w1 w2", "w0", "w3 w9 w20 w0", "none", "", " ".join(words)]
    qs = spark.createDataFrame(list(enumerate(asked)), "query_id long, q string")
    index = KW.KeywordIndex.build(docs, "doc_id", {"text": F.col("text")})
    monkeypatch.setattr(KW, "BLOCK_DOCS", 16)
    monkeypatch.setattr(KW, "MANY_BLOCKS", 4)
    monkeypatch.setattr(KW, "QUERY_ROWS", 2)
    assert index.blocks == 13
    got = {}
    for r in index.search(qs, 12).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score, r.attribute))
    mean = sum(map(len, texts)) / len(texts)
    for q, text in enumerate(asked):
        score = [0.0] * len(texts)
        for w in set(text.split()):
            df = sum(w in t for t in texts)
            for i, t in enumerate(texts):
                score[i] += math.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / mean)) if w in t else 0.0
        want = sorted((i for i in range(len(texts)) if score[i] > 0), key=lambda i: (-round(score[i], 6), i))[:12]
        assert [d for d, _, _ in got.get(q, [])] == want, text
        assert all(abs(s - score[d]) < 2e-6 and a == 0 for d, s, a in got.get(q, []))


def test_hybrid_search_in_blocks_hands_on_few_rows_and_is_exact(spark, monkeypatch):
    """a block of documents hands on the best of each query, whatever its words match; any blocks give the same rows."""
    import numpy as np
    from codeindex.operators import keyword as KW, search as SR
    from codeindex.operators.vectors import VectorIndex
    rng = np.random.default_rng(4)
    rows = [(i, f"common word{i % 7} " + "rare " * (i % 50 == 3), rng.normal(size=4).tolist() if i % 9 else None) for i in range(300)]
    rows += [(300, "common", [1.0, 2.0]), (301, None, [0.0, 0.0]), (302, "", [0.5, 1.0])]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, embedding array<double>")
    qs = spark.createDataFrame([(1, "common word3", rows[5][2]), (2, "rare", None), (3, "none", [1.0, 2.0]), (4, None, None), (5, "common", [2.0, 4.0])],
                               "query_id long, q string, embedding array<double>")
    words, vectors = KW.KeywordIndex.build(corpus, "doc_id", {"text": F.col("text")}), VectorIndex.build(corpus, "doc_id", "embedding")
    whole = sorted(map(tuple, SR.search_hybrid(corpus, qs, words, vectors, k=6).collect()))
    assert [r[1] for r in whole if r[0] == 4] == [0, 1, 2, 3, 4, 5] and {r[2] for r in whole if r[0] == 4} == {0.0}
    assert {r[1:] for r in whole if r[0] == 3} >= {(300, 0.7, 1), (302, 0.7, 2)}
    found, one = [], SR.mixed_candidates
    monkeypatch.setattr(SR, "mixed_candidates", lambda *a: found.append(out := one(*a)) or out)
    monkeypatch.setattr(KW, "BLOCK_DOCS", 40)
    monkeypatch.setattr(SR, "QUERY_ROWS", 2)
    assert sorted(map(tuple, SR.search_hybrid(corpus, qs, words, vectors, k=6).collect())) == whole
    assert found[0].count() <= 5 * 6 * words.blocks


def test_hybrid_search_counts_the_words_of_a_repeated_key_once(spark):
    """A key with two vectors was looked up twice, so its text counted twice where the keyword list ended before it."""
    from codeindex.operators import keyword as KW, search as SR
    from codeindex.operators.vectors import VectorIndex
    rows = [(i, "alpha " * (i + 2), [0.0, 1.0]) for i in range(10)] + [(10, "alpha pad pad pad", [1.0, 0.0])] * 2
    corpus = spark.createDataFrame(rows, "doc_id long, text string, embedding array<double>")
    qs = spark.createDataFrame([(1, "alpha", [1.0, 0.0])], "query_id long, q string, embedding array<double>")
    words = KW.KeywordIndex.build(corpus.dropDuplicates(["doc_id"]), "doc_id", {"text": F.col("text")})
    kw = {r.doc_id: r.score for r in words.search(qs, 50).collect()}
    assert min(kw, key=kw.get) == 10
    got = SR.search_hybrid(corpus, qs, words, VectorIndex.build(corpus, "doc_id", "embedding"), k=1, depth=2).collect()
    assert [(r.doc_id, r.rank) for r in got] == [(10, 1)] and abs(got[0].score - (0.7 + 0.3 * kw[10] / max(kw.values()))) < 2e-6


def test_payloads_land_packed_in_bounded_files_and_streams_leave_little(spark, monkeypatch):
    """Landed payloads were the largest part of the disk; packed files stay small, so many tasks read them."""
    import os
    from codeindex.sources import landing, pulls as SP
    monkeypatch.setattr(landing, "FILE_ROWS", 50)
    rows = [(i, f"title {i} " + "x" * 500) for i in range(320)]
    path = landing.landed(spark, "packed-test", "some", lambda: spark.createDataFrame(rows, "number long, title string").coalesce(1), packed=True)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 7 and all(f.endswith(".json.gz") for f in files)
    assert sorted(map(tuple, spark.read.schema("number long, title string").json(path).collect())) == rows
    size = sum(os.path.getsize(f"{path}/{f}") for f in files)
    assert size < 320 * 500 / 4 and SP.landed_bytes(spark, path) == SP.PACKED * size
