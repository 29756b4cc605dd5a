"""Spark-side behaviours: bytes, base64, zip, timestamps, regex guard, batching, sinks."""

import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_invalid_utf8_dropped(spark):
    from codeindex.operators import files as FL
    df = spark.createDataFrame([(1, "r/a.py", "good"), (1, "r/b.py", None)], "repository_id long, entry string, t string")
    df = df.withColumn("content", F.when(F.col("t").isNull(), F.unhex(F.lit("C328"))).otherwise(F.encode("t", "UTF-8")))
    got = FL.entries_to_files(df.drop("t")).collect()
    assert [(r.file_path, r.content, r.size) for r in got] == [("a.py", "good", 4)]
    assert FL.utf8_rejects(df.drop("t")).count() == 1


def test_base64_with_line_breaks(spark):
    from codeindex.sources.tree import decode_blobs
    import base64
    text = "héllo " * 40
    b64 = base64.encodebytes(text.encode()).decode()  # wrapped every 76 chars
    df = spark.createDataFrame([("u", "base64", b64)], "url string, encoding string, content string")
    r = decode_blobs(df).first()
    assert r.text == text and r.utf8 and r.size == len(text.encode())


def test_zip_archives_via_binary_file(spark):
    from codeindex.operators import files as FL
    from codeindex.sources.archives import archive_sizes, expand_archives, read_archives
    d = tempfile.mkdtemp(prefix="codeindex-zip-")
    os.makedirs(f"{d}/repository_id=7/branch=feature%2Fa-b")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("top-abc/", b"")
        z.writestr("top-abc/src/a.py", "print(1)\n")
        z.writestr("top-abc/.github/x.yml", "a: 1")
        z.writestr("top-abc/bin/x.bin", b"\x00\x01")
        z.writestr("top-abc/src/bad.py", b"\xc3\x28")
    with open(f"{d}/repository_id=7/branch=feature%2Fa-b/archive.zip", "wb") as fh:
        fh.write(buf.getvalue())
    arch = read_archives(spark, d)
    files = FL.entries_to_files(expand_archives(arch)).collect()
    assert [(r.repository_id, r.file_path, r.language) for r in files] == [(7, "src/a.py", "python")]
    assert [tuple(r) for r in archive_sizes(arch).collect()] == [(7, "feature/a-b", len(buf.getvalue()), 1)]


def test_parse_epoch_edge_cases(spark):
    from codeindex.functions.times import parse_epoch
    cases = [(None, None), ("", None), ("not-a-date", None), ("12:00", None), ("2024", None),
             ("2024-01-15T12:00:00Z", 1705320000), ("2024-01-15T12:00:00+09:00", 1705287600),
             ("2024-01-15T12:00:00.987Z", 1705320000), ("20240115T120000Z", 1705320000),
             ("2024-01-15", 1705276800), ("20240115", 1705276800), ("20240115T120000", 1705320000),
             ("2024-W03-1", 1705276800), ("2024W031", 1705276800), ("2024-W03", 1705276800),
             ("2024-01-15 12:00:00 Europe/Paris", None), ("20241399", None), ("2024-W60-1", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "ts string")
    got = [r[0] for r in df.select(parse_epoch(F.col("ts"))).collect()]
    assert got == [want for _, want in cases]


def test_c_function_regex_survives_long_unpunctuated_text(spark):
    from codeindex.functions.columns import extract_function
    text = "int " + " ".join(["word"] * 20000) + "\nstatic int f(int a) {\n}\n"
    df = spark.createDataFrame([(text, "cpp")], "t string, language string")
    assert df.select(extract_function(F.col("t"), F.col("language"))).first()[0] == "f"


def test_model_sees_at_most_twenty_texts_per_call(spark):
    import numpy as np
    from codeindex.operators.embed import model_embedder

    def load():
        return lambda texts: np.array([[len(texts)] for _ in texts], dtype=float)

    df = spark.range(0, 1000, numPartitions=2).select(F.col("id").cast("string").alias("t"))
    sizes = [r.e[0] for r in df.select(model_embedder(load, 1)("t").alias("e")).collect()]
    assert max(sizes) == 20 and len(sizes) == 1000


def test_bad_archives_and_blobs_are_rejected_and_the_rest_goes_on(spark):
    from codeindex.sources.archives import archive_rejects, expand_archives
    from codeindex.sources.tree import decode_blobs
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("top/src/a.py", "print(1)")
    df = spark.createDataFrame([(1, "main", bytearray(buf.getvalue())), (2, "main", bytearray(b"not a zip")), (3, "main", None)],
                               "repository_id long, branch string, content binary")
    assert [(r.repository_id, r.branch, r.entry) for r in expand_archives(df).collect()] == [(1, "main", "top/src/a.py")]
    assert sorted((r.repository_id, r.error) for r in archive_rejects(df).collect()) == [(2, "bad archive: BadZipFile"), (3, "bad archive: BadZipFile")]
    blobs = spark.createDataFrame([("a", "base64", "YQ=="), ("b", "base64", "*"), ("c", "base64", "//4=")], "url string, encoding string, content string")
    assert [(r.base64, r.utf8, r.text) for r in decode_blobs(blobs).orderBy("url").collect()] == [(True, True, "a"), (False, False, None), (True, False, None)]


def test_wrong_vector_sizes_are_split_off(spark):
    from codeindex.operators.embed import as_vectors, split_by_dims
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)], "id string, e array<float>")
    good, bad = split_by_dims(df.select("id", as_vectors(F.col("e")).alias("_vectors")), 2)
    assert [r.id for r in good.collect()] == ["a"] and sorted(r.id for r in bad.collect()) == ["b", "c"]


def test_chunk_error_becomes_whole_file(spark):
    from codeindex.operators.chunking import _pieces_udf
    df = spark.createDataFrame([("abc " * 300, "python", "split", None)],
                               "content string, language string, route string, size int")
    r = df.select(_pieces_udf(False)("content", "language", "route", "size").alias("c")).first().c
    assert r.pieces == ["abc " * 300] and r.error


def test_empty_batch_is_noop_and_upsert_idempotent(spark):
    from codeindex.operators.index import IndexTable
    from codeindex.session import new_path
    t = IndexTable(spark, new_path(spark, "t-index"))
    empty = spark.createDataFrame([], "index_name string, id string, v long")
    assert t.write_batch(empty, 0) is False and not t.exists()
    b1 = spark.createDataFrame([("i", "a", 1), ("i", "b", 1)], "index_name string, id string, v long")
    b2 = spark.createDataFrame([("i", "a", 2), ("i", "c", 2)], "index_name string, id string, v long")
    t.write_batch(b1, 1)
    t.write_batch(b2, 2)
    first = sorted(tuple(r) for r in t.read().collect())
    t.write_batch(b2, 2)  # retried batch
    assert sorted(tuple(r) for r in t.read().collect()) == first == [("i", "a", 2), ("i", "b", 1), ("i", "c", 2)]


def test_result_independent_of_partition_count(spark):
    import __spark_entry__ as E
    q = E.queries()["code_documents"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted((r.id, r.text) for r in q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted((r.id, r.text) for r in q(spark, SF_SMALL).collect())
    assert a == b and len(a) > 0
    assert len({i for i, _ in a}) == len(a)  # unique ids


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "id" in df.columns and "text" in df.columns


def test_model_embedder_plugs_in(spark):
    import numpy as np
    from codeindex.operators.embed import attach_vectors, model_embedder

    def load():
        return lambda texts: np.array([[len(t), 1.0, 0.0] for t in texts])

    # one id under two index names: vectors meet their own row
    docs = spark.createDataFrame([("i", "a", "xyz"), ("j", "a", "x"), ("i", "b", "")], "index_name string, id string, text string")
    vecs = docs.withColumn("embedding", model_embedder(load, 3)("text"))
    got = sorted((r.index_name, r.id, list(r._vectors["default"])) for r in attach_vectors(docs, vecs).collect())
    assert got == [("i", "a", [3.0, 1.0, 0.0]), ("i", "b", [0.0, 1.0, 0.0]), ("j", "a", [1.0, 1.0, 0.0])]


def test_java_gate_needs_two_signatures(spark):
    from codeindex.functions.columns import java_gate
    from codeindex.operators.chunking import with_route
    one = "public class A {\n  public void a() {\n  }\n}\n" + "// filler line\n" * 40
    two = "public class A {\n  public void a() {\n  }\n  private int b() {\n    return 1;\n  }\n}\n"
    df = spark.createDataFrame([("one", one, "java"), ("two", two, "java"), ("kt", two, "kotlin")],
                               "k string, content string, language string")
    got = {r.k: (r.g, r.route) for r in with_route(df).select("k", java_gate("content", "language").alias("g"),
                                                               "route").collect()}
    assert got == {"one": (False, "split"), "two": (True, "java"), "kt": (False, "whole")}


def test_a_model_sees_whole_files_until_twenty_documents(spark):
    import numpy as np
    from codeindex.operators.embed import embed_files

    def load():
        calls = [0]

        def model(texts):
            calls[0] += 1
            return np.array([[len(texts), calls[0]] for _ in texts], dtype=float)
        return model

    sizes = [1, 7, 30, 3, 3, 3, 3, 3, 3, 3, 45, 2, 1]  # documents of each file
    rows = [(1, f"f{i:02d}", k, "t") for i, n in enumerate(sizes) for k in range(n)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # files lie in several Arrow batches
    try:
        docs = spark.createDataFrame(rows, "repository_id long, file_path string, chunk_index int, text string").coalesce(1)
        out = embed_files(docs, "text", load, 2).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [(r.file_path, r.chunk_index) for r in out] == [(f, k) for _, f, k, _ in rows]
    calls = {}
    for r in out:
        size, call = r["_vectors"]["default"]
        calls.setdefault(int(call), []).append(r.file_path)
        assert size >= 1
    want, own = [], []
    for i, n in enumerate(sizes):  # gathered until 20 or more, whole files only
        own += [f"f{i:02d}"] * n
        if len(own) >= 20 or i == len(sizes) - 1:
            want.append(own)
            own = []
    assert [calls[k] for k in sorted(calls)] == want


def test_streams_take_a_model(spark):
    import numpy as np
    from codeindex.operators.embed import embed_files
    from codeindex.plans import stream_queries as STQ
    from conftest import SF_SMALL

    def load():
        return lambda texts: np.array([[len(t)] * STQ.STREAM_DIM for t in texts], dtype=float)

    table, _ = STQ._run_repo(spark, SF_SMALL, lambda docs, text: embed_files(docs, text, load, STQ.STREAM_DIM))
    rows = table.read().selectExpr("length(text) AS n", "_vectors['default'][0] AS v").collect()
    assert rows and all(r.n == r.v for r in rows)


def test_equal_scores_go_to_the_earlier_attribute(spark):
    from codeindex.operators import search as SR
    docs = spark.createDataFrame([("a", "x", "alpha", "y"), ("b", "alpha", "x", "y"), ("c", "x", "y", "alpha")],
                                 "id string, title string, body string, state string")
    docs = docs.withColumn("commit_messages", F.array("state")).withColumn("changed_files", F.array(F.lit("z")))
    qs = spark.createDataFrame([(1, "alpha")], "query_id long, q string")
    got = SR.search(docs, "pr", qs).orderBy("rank").collect()
    assert [r.id for r in got] == ["b", "a", "c"] and len({r.score for r in got}) == 1 and [r.attribute for r in got] == [0, 1, 2]


def test_keyword_floors_change_no_result(spark, monkeypatch):
    import random
    from codeindex.operators import keyword as KW
    random.seed(8)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(random.choices(words, weights=[1 / (k + 1) for k in range(60)], k=random.randint(0, 30)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    qs = spark.createDataFrame([(i, " ".join(random.sample(words, n)), ) for i, n in enumerate([1, 2, 3, 5, 8, 20, 60])] + [(99, "unknown")], "query_id long, q string")
    index = KW.KeywordIndex.build(docs, "doc_id", {"text": F.col("text")})
    plain = KW.KeywordIndex.open(spark, index.root)
    for k in (1, 3, 10):
        terms = index.query_terms(qs, "query_id", "q", k)
        assert k > 3 or terms.where("NOT essential OR least > 0").count() > 0
        got = sorted(map(tuple, index.search(qs, k).collect()))
        monkeypatch.setattr(KW, "DEEPEST", 0)  # no floor: every posting counts
        assert got == sorted(map(tuple, plain.search(qs, k).collect()))
        monkeypatch.setattr(KW, "DEEPEST", 100)


def test_vector_search_reads_part_of_the_rows_and_is_exact(spark):
    import numpy as np
    from codeindex.operators.vectors import VectorIndex
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 12))
    v = centres[rng.integers(0, 30, 3000)] + 0.05 * rng.normal(size=(3000, 12))
    v[5] = 0
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(4000, None), (4001, [1.0, 2.0]), (4002, [2.0, 4.0])]
    corpus = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    qs = corpus.where("doc_id % 100 = 7 or doc_id >= 4000").select(F.col("doc_id").alias("query_id"), "embedding")
    index = VectorIndex.build(corpus, "doc_id", "embedding")
    got = {}
    for r in index.search(qs, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert 4000 not in got and [d for d, _ in got[4001]] == [4001, 4002]
    u = v / np.where(np.linalg.norm(v, axis=1) > 0, np.linalg.norm(v, axis=1), 1)[:, None]
    for q in range(7, 3000, 100):
        s = np.round(u @ u[q], 6)
        s[5] = -2
        want = np.lexsort((np.arange(3000), -s))[:5]
        assert [d for d, _ in got[q]] == want.tolist()
    took = index.candidates(qs, 5).agg(F.sum("products")).first()[0]
    assert took < 0.3 * 3000 * 30


def test_hybrid_search_joins_few_pairs_and_is_exact(spark, monkeypatch):
    import random
    import numpy as np
    from codeindex.operators import search as SR
    from codeindex.operators.keyword import KeywordIndex
    from codeindex.operators.vectors import VectorIndex
    random.seed(9)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(random.choices(words, k=random.randint(0, 12))) for _ in range(500)]
    texts[100:160] = ["w1 w2"] * 60  # many equal documents
    vecs = rng.normal(size=(500, 6))
    vecs[100:160] = vecs[100]
    vecs[7] = 0
    corpus = spark.createDataFrame([(i, t, v.tolist()) for i, (t, v) in enumerate(zip(texts, vecs, strict=True))], "doc_id long, text string, embedding array<double>")
    asked = [(i, q, vecs[j].tolist()) for i, (q, j) in enumerate([("w1 w2", 100), ("w5", 3), ("none", 7), ("", 20), ("w3 w9 w30", 40)])]
    qs = spark.createDataFrame(asked, "query_id long, q string, embedding array<double>")
    words_index, vector_index = KeywordIndex.build(corpus, "doc_id", {"text": F.col("text")}), VectorIndex.build(corpus, "doc_id", "embedding")
    pairs = []
    whole = SR.complete
    monkeypatch.setattr(SR, "complete", lambda *a: pairs.append(out := whole(*a)) or out)
    got = {}
    for r in SR.search_hybrid(corpus, qs, words_index, vector_index, k=4, depth=2).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    kw = {(r.query_id, r.doc_id): r.score for r in words_index.search(qs, 500).collect()}
    unit = vecs / np.where(np.linalg.norm(vecs, axis=1) > 0, np.linalg.norm(vecs, axis=1), 1)[:, None]
    for q, text, v in asked:
        v = np.array(v)
        sem = np.maximum(0, np.round(unit @ (v / (np.linalg.norm(v) or 1)), 6))
        best = max((s for (a, _), s in kw.items() if a == q), default=0)
        score = [np.floor((0.7 * sem[d] + (1 - 0.7) * (kw.get((q, d), 0) / best if best else 0)) * 1e6 + 0.5) / 1e6 for d in range(500)]
        want = sorted(range(500), key=lambda d: (-score[d], d))[:4]
        assert got[q] == [(d, score[d]) for d in want], (q, text)
    assert pairs[0].count() <= 5 * (2 * 8 + 4)  # both lists to depth 2 * k, and the smallest keys
