"""Operator 3: Viterbi against plain dynamic programming, accuracy on held-out documents, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from codeindex.llm import langid, queries
from llm_frames import frame  # noqa: F401  (a fixture)

SF = "/root/testdata/sf0.01"


def plain(scores, switch):
    n = scores.shape[1]
    v, back = scores[0].copy(), []
    for row in scores[1:]:
        came = np.array([max(range(n), key=lambda i, j=j: (v[i] - switch * (i != j), i == j, -i)) for j in range(n)])
        v = np.array([v[came[j]] - switch * (came[j] != j) for j in range(n)]) + row
        back.append(came)
    path = [int(v.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return v.max(), path[::-1]


def total(scores, path, switch):
    return sum(s[p] for s, p in zip(scores, path, strict=True)) - switch * sum(a != b for a, b in zip(path, path[1:], strict=False))


def test_viterbi_finds_a_best_path():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 5, 64, 65, 130, 300, 0, 128]
    scores = rng.normal(size=(sum(sizes), 3)) * 4
    first = np.concatenate([[0], np.cumsum(sizes)])
    got = langid.viterbi(scores, first, 5.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            best, _ = plain(scores[a:b], 5.0)
            assert abs(total(scores[a:b], got[a:b], 5.0) - best) < 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op3_language_id(spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    assert len(got) > 100 and np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), "text", "lang")


def test_spans_of_mixed_text_and_odd_rows(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    de, fr = (docs.where((F.col("lang") == x) & (F.length("text") > 600)).orderBy("doc_id").first().text[:500] for x in ("de", "fr"))
    texts = [f"{de} {fr}", None, "", " 12 34 — !!", "привет мир", "x", de, de, "wort " * 30000]
    got = {r.id: r for r in langid.predict(frame(texts), "doc_id", "text", model(spark), spans=True).collect()}
    assert [s.lang for s in got[0].spans] in (["de", "fr"], ["fr", "de"])
    assert abs(got[0].spans[0].end - 500) < 40
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].score == 0 and got[4].lang_pred in ("de", "en", "es", "fr")
    assert got[6].lang_pred == got[7].lang_pred == "de" and got[6].score == got[7].score


def test_prediction_does_not_depend_on_neighbours(spark, frame):
    m = model(spark)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    one = {r.id: (r.lang_pred, r.score) for r in langid.predict(frame(texts).coalesce(1), "doc_id", "text", m).collect()}
    two = {r.id: (r.lang_pred, r.score) for r in langid.predict(frame(texts).repartition(60), "doc_id", "text", m).collect()}
    assert one == two


def test_nothing_to_learn_from(spark, frame):
    m = langid.fit(frame([], lang="en"), "text", "lang")
    assert [r.lang_pred for r in langid.predict(frame(["abc", None]), "doc_id", "text", m).collect()] == ["und", "und"]
