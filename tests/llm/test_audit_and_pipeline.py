"""Operator 5 against a plain comparison of records; the pipeline's stages against brute force."""

import hashlib
import random
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from codeindex.llm import merkle_audit, queries
from llm_frames import frame  # noqa: F401  (a fixture)


def record(k, url, body):
    body = body or ""
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nWARC-Record-ID: <urn:page:{k}>\r\n"
            f"Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n").encode()


def brute(own, other, per_file=merkle_audit.FILE_RECORDS):
    out, at, last = {}, 0, None
    for k in sorted(set(own) | set(other)):
        if k // per_file != last:
            at, last = 0, k // per_file
        a, b = own.get(k), other.get(k)
        if a != b:
            status = "extra" if a is None else "missing" if b is None else "changed"
            out[k] = (k // per_file, None if a is None else at, status, a and hashlib.sha256(a).hexdigest(), b and hashlib.sha256(b).hexdigest())
        at += len(a or b"")
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_audit_of_the_given_pages(spark, sf):
    own, other = {}, {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        own[r.page_id] = record(r.page_id, r.url, r.html)
        code = zlib.crc32(str(r.page_id).encode())
        if code % 97 != 5:
            other[r.page_id] = record(r.page_id, r.url, "#" + r.html[1:]) if code % 61 == 7 and r.html is not None else own[r.page_id]
    got = {r.page_id: (r.file, r.start, r.status, r.hash, r.replica_hash) for r in queries.op5_merkle_audit(spark, sf).collect()}
    assert got == brute(own, other) and got


def test_audit_across_files_and_levels(spark, monkeypatch):
    monkeypatch.setattr(merkle_audit, "FILE_RECORDS", 5)
    monkeypatch.setattr(merkle_audit, "FAN_OUT", 3)
    monkeypatch.setattr(merkle_audit, "RANGE_BYTES", 300)
    rng = random.Random(1)
    own = {k: record(k, f"u{k}", "x" * rng.randint(0, 200)) for k in range(200) if k % 7}
    other = {k: v for k, v in own.items() if k not in (3, 51, 52, 53, 54, 55)} | {9: b"other", 500: b"new", 14: b"new"}
    frames = [spark.createDataFrame([(k, v.decode()) for k, v in x.items()], "id long, record string") for x in (own, other)]
    got = {r.id: (r.file, r.start, r.status, r.hash, r.replica_hash) for r in merkle_audit.audit(*frames).collect()}
    assert got == brute(own, other, 5)
    assert merkle_audit.audit(frames[0], frames[0]).count() == 0
    none = frames[0].limit(0)
    assert merkle_audit.audit(none, none).count() == 0 and merkle_audit.audit(none, frames[0]).count() == len(own)


@pytest.mark.parametrize("ids", [[-1, 0], [-20, -5, -1, 3, 40], [-7], [10**12, 10**12 + 1, -3]])
def test_audit_of_negative_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(merkle_audit, "FILE_RECORDS", 2)
    own = {k: record(k, f"u{k}", "x") for k in ids}
    other = own | {ids[0]: b"other"}
    frames = [spark.createDataFrame([(k, v.decode()) for k, v in x.items()], "id long, record string") for x in (own, other)]
    got = {r.id: (r.file, r.start, r.status, r.hash, r.replica_hash) for r in merkle_audit.audit(*frames).collect()}
    assert got == brute(own, other, 2)


def test_records_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", "b", "x"), (2, "u", "é", "x"), (2, "u", "é", "x")], "page_id long, url string, html string, record string")
    got = sorted((r.id, r.record.encode()) for r in merkle_audit.warc_records(pages, "page_id", "url", "html").collect())
    assert got == [(1, record(1, None, None)), (2, record(2, "u", "é")), (2, record(2, "u", "é"))]


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n))


def test_stages_on_planted_documents(spark, frame, tmp_path):
    rng = random.Random(11)
    passage, item = words(rng, 70), words(rng, 40)
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = words(rng, 150)
    clean = [words(rng, 80) for _ in range(10)]
    texts = [*clean, near, near + " tail", near, f"{words(rng, 60)} {passage}", f"{words(rng, 60)} {passage}", f"{words(rng, 30)} {item}", None, "", "123 456", passage]
    docs = frame(texts, lang="en")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "id", "n", "key"]
    assert set(range(20)) - set(steps["language_id"]) == {16, 17, 18}
    assert set(steps["language_id"]) - set(steps["ngram_jaccard"]) == {11, 12}
    assert set(steps["ngram_jaccard"]) - set(steps["substring_dedup"]) == {19}
    assert steps["substring_dedup"][14].text.split() == texts[14].split()[:60] and steps["substring_dedup"][13].text == texts[13]
    assert set(steps["substring_dedup"]) - set(steps["benchmark_decontamination"]) == {15}
    assert set(range(10)) <= set(steps["byte_bpe"])
    for k, r in steps["byte_bpe"].items():
        text = steps["benchmark_decontamination"][k].text
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_tokens == len(r.ids)


def test_the_language_model_rejects_unknown_scripts(spark, frame):
    texts = ["the words of a text", "los textos de una tabla", "слова другого письма", "字", "12 34", "the слова of two scripts"] * 8
    docs = frame(texts, lang="en")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.withColumn("lang", F.when(F.col("doc_id") % 6 < 2, "en")), "").collect()}
    assert kept == {i for i in range(len(texts)) if i % 6 in (0, 1, 5)}


def test_run_keeps_clean_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0.5 * n < out.count() < n and out.where(F.size("ids") == 0).count() == 0
