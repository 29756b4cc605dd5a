"""Operator 12 against all pairs in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeindex.llm import hard_negatives
from codeindex.llm.hard_negatives import HIGHEST, LOWEST, Goals, walk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, q int, block int"


def brute(rows, positives=5, negatives=10, step=100):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a in sorted(i for i in q if i % step == 0):
        label, u = q[a]
        scores = [(-sum(x * y for x, y in zip(u, v, strict=True)), i, other == label) for i, (other, v) in q.items() if i != a and len(v) == len(u)]
        for p, pos, _ in sorted(x for x in scores if x[2])[:positives]:
            fits = sorted(x for x in scores if not x[2] and -30 * p <= -100 * x[0] <= -90 * p)
            out += [(a, pos, k, i, -p, -s) for k, (s, i, _) in enumerate(fits[:negatives], 1)]
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives.mine(df, "vec_id", "embedding", "label", F.col("id") % 100 == 0, **more).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    v = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 8)) * 0.3
    out = [(i, x.tolist(), int(rng.integers(0, 3))) for i, x in enumerate(v)]
    out[100] = (100, [0.0] * 8, 1)
    out[200] = (200, None, 1)
    out[300] = (300, [float("nan")] + [1.0] * 7, 1)
    out[301] = (301, [None] + [1.0] * 7, 1)
    out[400] = (400, out[400][1], None)
    out[500] = (500, [1.0, 2.0], 1)
    out += [(2000 + i, [1.0, 2.0 + i % 3], i % 2) for i in range(30)]  # another length, with ties
    out += [(3000 + i, out[600][1], 0) for i in range(200)]  # a hot vector
    out += [(7, [9.0] * 8, 2), (7, out[7][1], out[7][2]), (None, [1.0] * 8, 1), (5000, [], 1), (5001, [], 2)]
    return out


def test_equals_all_pairs(spark, rows):
    assert run(spark, rows) == sorted(brute(rows))


def test_many_groups_blocks_and_waves(spark, rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 400)
    monkeypatch.setattr(hard_negatives, "GROWTH", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert run(spark, rows) == sorted(brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 1e6).tolist(), i % 2) for i in range(150)]
    assert run(spark, rows) == sorted(brute(rows))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_walks_end_early_where_rows_cluster():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    own = rng.integers(0, 20, 20000)
    v = np.floor(256 * (centres[own] + rng.normal(size=(20000, 16)) * 0.02))
    members = np.flatnonzero(own == 3)[:50]
    n = len(members)
    goals = Goals(5, np.full((n, 1), LOWEST), np.full((n, 1), HIGHEST), np.full((n, 1), LOWEST), np.full((n, 1), LOWEST))
    took = walk(v[members], members, np.zeros(n, int), True, goals, v, np.arange(20000), np.zeros(20000, int))
    assert took < 0.25 * n * 20000
    for m, i in enumerate(members):
        s = v @ v[i]
        want = [j for j in np.lexsort((np.arange(20000), -s)) if j != i][:5]
        assert goals.found[m, 0][0].tolist() == want
