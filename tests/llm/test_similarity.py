"""Operators 7 and 8 against all pairs; components."""

import random

import numpy as np
import pytest

from codeindex.llm import chosen_path, pivot_index, queries
from codeindex.llm.components import components
from llm_frames import frame  # noqa: F401  (a fixture)


def closure(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 120
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(70)] + [(i, i + 1) for i in range(100, n - 1)] + [(0, 0)]
    want = closure(n, links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, w=5):
    ws = (text or "").lower().split()
    return {tuple(ws[i:i + w]) for i in range(max(1, len(ws) - w + 1))} if ws else set()


def texts_with_copies():
    rng = random.Random(3)
    base = [[str(rng.randrange(4000)) for _ in range(rng.randint(60, 160))] for _ in range(12)]
    out = []
    for ws in base:
        out.append(ws)
        for _ in range(rng.randint(0, 8)):  # chains of near copies
            near = list(rng.choice([ws, out[-1]]))
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = str(rng.randrange(4000))
            out.append(near)
    passage = [str(rng.randrange(4000)) for _ in range(30)]
    out += [passage + [str(rng.randrange(4000)) for _ in range(120)] for _ in range(90)]  # a passage of many texts
    copies = [" ".join(ws) for ws in out] + [" ".join(base[0])] * 5 + ["", None, "one two", "One two", "one", "a b c d e", " ".join("xy" for _ in range(50))]
    rng.shuffle(copies)
    return copies


def test_jaccard_join_equals_all_pairs(frame):
    texts = texts_with_copies()
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and sets[b]]
    want = closure(len(sets), links)
    got = {r.id: r for r in chosen_path.similarity_classes(frame(texts), "doc_id", "text").collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].n_links == sum(i in x for x in links) and got[i].class_id == want[i]


def test_large_groups_are_verified_in_blocks(frame, monkeypatch):
    rng = random.Random(4)
    base = [str(rng.randrange(4000)) for _ in range(300)]
    texts = []
    for _ in range(70):
        near = list(base)
        near[rng.randrange(300)] = str(rng.randrange(4000))
        texts.append(" ".join(near))
    sets = [shingles(t) for t in texts]
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    got = {r.id: r for r in chosen_path.similarity_classes(frame(texts), "doc_id", "text").collect()}
    for i, s in enumerate(sets):
        assert got[i].class_id == 0 and got[i].n_links == sum(len(s & t) >= 0.8 * len(s | t) for t in sets) - 1


def test_members_at_the_threshold_of_large_groups(frame, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    texts = []
    for g in range(3):
        base = [f"{g}x{i}" for i in range(300)]
        for _ in range(24):
            texts.append(" ".join([*base, str(rng.randrange(10**6))]))
        # 30 of 297 shingles changed: Jaccard of about 0.82 with all others of the group
        texts.append(" ".join([*(f"new{g}y{i}" for i in range(29)), *base[29:], "end"]))
    sets = [shingles(t) for t in texts]
    got = {r.id: r for r in chosen_path.similarity_classes(frame(texts), "doc_id", "text").collect()}
    for i, s in enumerate(sets):
        own = i // 25 * 25
        assert got[i].n_links == sum(len(s & t) >= 0.8 * len(s | t) for t in sets[own:own + 25]) - 1 == 24 and got[i].class_id == own, i


def test_runs_follow_the_depth():
    for depth in range(2, 8):
        n = chosen_path.runs_for(depth, 0.8)
        assert n >= chosen_path.RUNS and (1 - 0.8**depth) ** n <= chosen_path.MISSED


def test_jaccard_join_of_no_rows_and_repeated_rows(frame):
    assert chosen_path.similarity_classes(frame([]), "doc_id", "text").count() == 0
    got = chosen_path.similarity_classes(frame(["a b c d e f", "a b c d e f", "x"], [4, 4, None]), "doc_id", "text").collect()
    assert [(r.id, r.class_id, r.n_links) for r in got] == [(4, 4, 0)]


def test_one_row_stands_for_an_id(frame, monkeypatch):
    rng = random.Random(2)
    ws = [[str(rng.randrange(4000)) for _ in range(80)] for _ in range(2)]
    near = [" ".join([*w[:40], "x", *w[41:]]) for w in ws]
    # id 5 has both texts; whichever stands for it, it links with the near copies of that one only
    rows = [(5, " ".join(ws[0])), (5, " ".join(ws[1])), (1, near[0]), (2, near[1])]
    results = set()
    for order in (rows, rows[::-1]):
        got = {r.id: (r.class_id, r.n_links) for r in chosen_path.similarity_classes(frame([t for _, t in order], [i for i, _ in order]), "doc_id", "text").collect()}
        results.add(tuple(sorted(got.items())))
    assert len(results) == 1
    (only,) = results
    assert sorted(n for _, (_, n) in only) == [0, 1, 1] and dict(only)[5][1] == 1


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for size in (20, 60, 900):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        b = a.copy()
        b[: size // 5] = rng.integers(0, 1 << 63, size // 5, dtype=np.uint64)
        h = np.concatenate([np.sort(chosen_path.seeded(a, 7)), np.sort(chosen_path.seeded(b, 7))])
        x, y = chosen_path.sketches(h, np.array([0, size, 2 * size]))
        assert abs((x == y).mean() - 2 / 3) < 0.25


def test_pivot_index_recall_and_precision(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 32))
    v = np.concatenate([centres + rng.normal(size=(60, 32)) * s for s in (0.1, 0.2, 0.3, 0.35, 0.4)] + [rng.normal(size=(200, 32))])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    close = np.triu(unit @ unit.T >= 0.9, 1)
    rows = [(i, [float(y) for y in x], "x") for i, x in enumerate(v)]
    got = {r.id: r for r in pivot_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string"), "vec_id", "embedding").collect()}
    full = close | close.T
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= full[i].sum() for i in got) and found >= 0.9 * full.sum() > 100


@pytest.mark.parametrize(("dim", "share", "noise"), [(32, 0.33, 0.3), (64, 0.33, 0.2), (64, 0.6, 0.32)])
def test_recall_with_one_large_near_group(spark, dim, share, noise):
    rng = np.random.default_rng(dim)
    n = 1500
    hot = int(n * share)
    centres = np.repeat(rng.normal(size=((n - hot) // 6, dim)), 3, axis=0)
    v = np.concatenate([rng.normal(size=dim) + rng.normal(size=(hot, dim)) * noise, centres + rng.normal(size=centres.shape) * 0.25])
    v = np.concatenate([v, rng.normal(size=(n - len(v), dim))])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    full = unit @ unit.T >= 0.9
    np.fill_diagonal(full, False)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = {r.id: r.n_links for r in pivot_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    assert all(got[i] <= full[i].sum() for i in got)
    for part in (slice(0, hot), slice(hot, n)):
        assert sum(got[i] for i in range(n)[part]) >= 0.9 * full[part].sum() > 0


def test_every_length_links_with_its_own(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.1 * (i % 7)).tolist()) for i in range(100)]
    rows += [(200 + i, (np.ones(4) + rng.normal(size=4) * 0.02).tolist()) for i in range(10)]
    rows += [(300 + i, [1.0 + i, 1.0]) for i in range(5)] + [(400, [3.0]), (401, [-3.0]), (402, [1e300]), (403, [0.5])]
    got = {r.id: r.n_links for r in pivot_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    want = {}
    for i, v in rows:
        u = np.array(v) / np.abs(v).max()
        others = [np.array(w) / np.abs(w).max() for j, w in rows if j != i and len(w) == len(v)]
        want[i] = sum(u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= 0.9 for w in others)
    for part in (range(100), range(200, 210), range(300, 305), range(400, 404)):
        assert all(got[i] <= want[i] for i in part) and sum(got[i] for i in part) >= 0.9 * sum(want[i] for i in part) > 0
    assert all(got[i] == 9 for i in range(200, 210)) and got[400] == 2 and got[401] == 0


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    v = np.array([r.embedding for r in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    full = v @ v.T >= 0.9
    want = {r.vec_id: int(full[i].sum()) - 1 for i, r in enumerate(rows)}
    got = {r.vec_id: r.n_links for r in queries.op8_pivot_index(spark, "/root/testdata/sf0.1").collect()}
    assert all(got[k] <= n for k, n in want.items()) and sum(got.values()) >= 0.9 * sum(want.values())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]),
            (9, [1.0, 0.1]), (9, [1.0, 0.1]), (None, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in pivot_index.near_duplicates(df, "vec_id", "embedding").collect()}
    linked = {0: (3, 0), 1: (3, 0), 9: (3, 0), 11: (3, 0)}
    assert got == {k: linked.get(k, (0, k)) for k in range(12)}
    assert pivot_index.near_duplicates(df.limit(0), "vec_id", "embedding").count() == 0
