"""Operators 4, 6 and 9 against brute force and planted cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codeindex.llm import common, compact_windows, decontaminate, queries, suffix_dedup
from llm_frames import frame  # noqa: F401  (a fixture)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n))


def brute_bytes(rows, depth):
    """{id: (kept, spans)} by looking at every window of every text."""
    first = {}
    for k, text in rows:
        if k is not None:
            b = (text or "").encode()
            for i in range(len(b) - depth + 1):
                w = b[i:i + depth]
                first[w] = min(first.get(w, k), k)
    out = {}
    for k, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - depth + 1):
            if k is not None and first[b[i:i + depth]] < k:
                gone[i:i + depth] = True
        spans, start = [], None
        for i, g in enumerate(gone.tolist()):
            if g and start is None:
                start = i
            elif not g and start is not None:
                spans.append((start, i))
                start = None
        out[k] = (bytes(x for x, g in zip(b, gone.tolist(), strict=False) if not g), spans)
    return out


@pytest.mark.parametrize("group_bytes", [1 << 30, 3000, 300])
def test_suffix_dedup_equals_brute_force(frame, group_bytes):
    rng = random.Random(group_bytes)
    shared = [words(rng, 30) for _ in range(4)]
    texts = []
    for i in range(60):
        texts.append(" ".join(rng.choice([words(rng, rng.randint(0, 12)), rng.choice(shared), rng.choice(shared)[:rng.randint(20, 90)]]) for _ in range(rng.randint(0, 4))))
    texts += ["", None, "a" * 400, "a" * 49, "a" * 50, "é" * 60, "é" * 25, texts[3], texts[3], "ab" * 100, "xab" + "ab" * 60]
    ids = rng.sample(range(1000), len(texts))
    ids[5] = None
    got = {r.id: r for r in suffix_dedup.remove_repeats(frame(texts, ids), "doc_id", "text", group_bytes=group_bytes).collect()}
    want = brute_bytes(list(zip(ids, texts, strict=True)), 50)
    assert set(got) == set(want)
    for k, (kept, spans) in want.items():
        assert bytes(got[k].kept) == kept and [(s.start, s.end) for s in got[k].spans] == spans
        assert got[k].n_bytes - got[k].n_removed == len(kept)


def test_suffix_dedup_of_repeated_ids_and_no_rows(frame):
    text = "same text " * 10
    got = suffix_dedup.remove_repeats(frame([text, text], [1, 1]), "doc_id", "text").collect()
    assert [r.n_removed for r in got] == [0, 0]
    assert suffix_dedup.remove_repeats(frame([]), "doc_id", "text").count() == 0


def brute_windows(v, first, need):
    out = set()
    for a, b in zip(first[:-1], first[1:], strict=True):
        for c in range(a, b):
            left = c
            while left - 1 >= a and v[left - 1] > v[c]:
                left -= 1
            right = c
            while right + 1 < b and v[right + 1] >= v[c]:
                right += 1
            if right - left + 1 >= need:
                out.add((left, c, right))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=40), min_size=1, max_size=4), st.integers(1, 9))
def test_compact_windows_are_the_large_tree_nodes(rows, need):
    v = np.array([x << 40 for r in rows for x in r], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    got = set(zip(*(x.tolist() for x in compact_windows.compact_windows(v, first, need)), strict=True))
    assert got == brute_windows(v.tolist(), first.tolist(), need)


def planted(rng):
    """Texts, and the ids that repeat a passage of an earlier one."""
    passages = [words(rng, 70) for _ in range(3)]
    texts = [f"{words(rng, 60)} {passages[i % 3]} {words(rng, 50)}" for i in range(9)]
    changed = passages[0].split()
    changed[35] = "zzz"
    texts.append(f"{words(rng, 60)} {' '.join(changed)} {words(rng, 50)}")
    texts += [words(rng, 200) for _ in range(20)]
    texts += ["", None, words(rng, 30), f"{words(rng, 40)} {' '.join(passages[1].split()[:40])} {words(rng, 40)}"]
    return texts, {3, 4, 5, 6, 7, 8, 9}


@pytest.mark.parametrize("group_bytes", [1 << 30, 2000])
def test_passages_find_repeats_and_leave_the_rest(frame, group_bytes):
    texts, repeats = planted(random.Random(2))
    found = {r.id: r for r in compact_windows.passages(frame(texts), "doc_id", "text", group_bytes=group_bytes).collect()}
    assert set(found) == repeats
    for k, r in found.items():
        assert r.repeats[0].holder == (k % 3 if k < 9 else 0) and 65 <= r.repeats[0].words <= 75
        assert 105 <= len(r.kept.split()) <= 115


def test_whole_copies_and_many_holders(frame):
    rng = random.Random(5)
    body = words(rng, 120)
    texts = [f"{words(rng, 20)} {body}" if i % 2 else body for i in range(40)] + [words(rng, 100)]
    found = {r.id: r.kept for r in compact_windows.passages(frame(texts), "doc_id", "text").collect()}
    assert set(found) == set(range(1, 40)) and all(found[i].strip() == "" for i in range(2, 40, 2))


@pytest.mark.parametrize("group_bytes", [1 << 30, 4000])
def test_exact_repeats_behind_an_edited_first_holder(frame, group_bytes):
    rng = random.Random(11)
    texts, want = [], {}
    for _ in range(60):
        body = words(rng, 55).split()
        edited = list(body)
        for i in rng.sample(range(5, 50), 2):
            edited[i] = "zzz"
        for own in (edited, body, body):
            texts.append(f"{words(rng, 120)} {' '.join(own)} {words(rng, 120)}")
        want[len(texts) - 1] = len(texts) - 2
    # the first holder has a passage twice, and only the second place is whole
    body = words(rng, 60).split()
    texts += [f"{' '.join(body[:30])} {words(rng, 90)} {' '.join(body)} {words(rng, 20)}", f"{words(rng, 40)} {' '.join(body)} {words(rng, 30)}"]
    want[len(texts) - 1] = len(texts) - 2
    found = {r.id: r for r in compact_windows.passages(frame(texts), "doc_id", "text", group_bytes=group_bytes).collect()}
    for k, holder in want.items():
        assert k in found, k
        assert any(r.holder == holder and r.words >= 55 for r in found[k].repeats)
        assert len(found[k].kept.split()) <= len(texts[k].split()) - 55
    assert not {k for k in found if k not in want and texts[k].count("zzz") > 0}


def test_blocks_verify_matches_as_single_pairs_do():
    rng, schema = np.random.default_rng(5), pa.schema([("task", pa.int64()), ("id", pa.int64()), ("stretch", pa.int32()), ("low", pa.int32()), ("shingles", pa.binary()),
                                                       ("holder", pa.int64()), ("high", pa.int32()), ("low0", pa.int32()), ("high0", pa.int32())])
    rows, want, margin = [], set(), 2 * compact_windows.MIN_WORDS
    for task in range(6):
        base = rng.integers(0, 9 if task == 5 else 1 << 40, 300)
        texts = [np.where(rng.random(300) < rate, rng.integers(0, 1 << 40, 300), base).astype(np.uint64) for rate in (0, 0.02, 0.1, 0.3)]
        texts[3][150:] = texts[1][100:250]
        for k, h in enumerate(texts):
            rows.append({"task": task, "id": k, "stretch": 0, "low": 0, "shingles": h.tobytes()})
        for holder in range(4):
            for k in range(holder + 1, 4):
                for at, at0 in ((60, 60), (200, 150), (290, 290)):
                    rows.append({"task": task, "id": k, "holder": holder, "low": at, "high": at + 3, "low0": at0, "high0": at0 + 2})
                    a = max(0, at - margin)
                    want |= {(k, s, e, holder, score) for s, e, score in compact_windows.verify_passage(
                        texts[k][a:at + 4 + margin], a, texts[holder][max(0, at0 - margin):at0 + 3 + margin], 0.8)}
    batches = [pa.RecordBatch.from_pylist(rows[i:i + 7], schema) for i in range(0, len(rows), 7)]
    got = {tuple(r.values()) for b in compact_windows.verify_blocks(iter(batches), 0.8) for r in b.to_pylist()}
    assert got == want and len(want) > 20


def test_passages_leave_only_their_result_on_disk(frame, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    rng = random.Random(19)
    body = words(rng, 80).split()
    texts = [f"{words(rng, 60)} {' '.join('zzz' if i in gone else w for i, w in enumerate(body))} {words(rng, 60)}" for gone in ({9, 24, 40, 55, 70}, {30}, set(), {12})]
    assert compact_windows.passages(frame(texts), "doc_id", "text").count()
    assert {p.parent.name.rpartition("-")[0] for p in tmp_path.rglob("*.parquet") if "passages-" not in str(p)} == set()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dealt")]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_similar_passages_behind_an_unlike_first_holder(frame):
    rng = random.Random(17)
    texts, want = [], {}

    def placed(body, gone):
        return f"{words(rng, 120)} {' '.join('zzz' if i in gone else w for i, w in enumerate(body))} {words(rng, 120)}"

    for _ in range(40):
        body = words(rng, 60).split()
        # the last two differ by one word; the first holder differs from them by three or four others
        texts += [placed(body, {8, 22, 45, 52}), placed(body, {30}), placed(body, set())]
        want[len(texts) - 1] = len(texts) - 2
    # the first holder has the signatures twice, and only its second place is similar
    body = words(rng, 60).split()
    texts += [f"{' '.join(body[:30])} {words(rng, 90)} {' '.join(body)} {words(rng, 20)}", placed(body, {30})]
    want[len(texts) - 1] = len(texts) - 2
    found = {r.id: r for r in compact_windows.passages(frame(texts), "doc_id", "text").collect()}
    for k, holder in want.items():
        assert k in found and any(r.holder == holder and r.jaccard >= 0.8 for r in found[k].repeats), k
    assert set(found) <= set(want) | {k - 1 for k in want}


def test_surroundings_tell_common_shingles():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 1 << 62, 200).astype(np.uint64)
    h[100:] = np.resize(h[100:110], 100)
    low, high = np.zeros(3, np.int64), np.full(3, 200)
    bits, ask = compact_windows.surroundings(h, low, high, np.array([46, 160, 100]), 46)
    bit = compact_windows.seeded(h, 71) % compact_windows.U64(compact_windows.SKETCH)
    for row, (a, z, starts) in enumerate(((1, 92, range(1, 47)), (115, 200, range(115, 155)), (55, 146, range(55, 101)))):
        assert int(np.bitwise_count(bits[row]).sum()) == len(set(bit[a:z].tolist()))
        assert ask[row] == int(min(len(set(bit[s:s + 46].tolist())) for s in starts) * compact_windows.SHARE)


def test_passages_of_no_rows_and_clashing_ids(frame):
    assert compact_windows.passages(frame([]), "doc_id", "text").count() == 0
    text = words(random.Random(1), 100)
    assert compact_windows.passages(frame([text, text], [None, 4]), "doc_id", "text").count() == 0


def test_word_places_survive_lower_casing():
    text = "İstanbul İİ Ünal ß x"
    begin, end = compact_windows.word_places(text, pc.utf8_lower(pa.array([text]))[0].as_py())
    raw = text.encode()
    assert [raw[a:b].decode() for a, b in zip(begin, end, strict=True)] == text.split()


def brute_overlap(own, doc):
    """Longest stretch on any shift with enough agreeing words."""
    least, best = min(decontaminate.MIN_WORDS, len(own)), 0
    for shift in range(-len(own) + 1, len(doc)):
        agree = [doc[shift + j] == w if 0 <= shift + j < len(doc) else None for j, w in enumerate(own)]
        agree = [x for x in agree if x is not None]
        for a in range(len(agree)):
            for b in range(a + least, len(agree) + 1):
                if agree[a] and agree[b - 1] and sum(agree[a:b]) >= decontaminate.SHARE * (b - a) - 1e-9:
                    best = max(best, b - a)
    return best


def test_decontamination_equals_brute_force(spark, frame):
    rng = random.Random(7)
    items = [words(rng, n) for n in (40, 25, 14, 12, 8, 1, 0)] + [None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    def changed(text, every):
        return " ".join(w if i % every else "zz" for i, w in enumerate(text.split(), 3))

    docs = [f"{words(rng, 30)} {items[0]} {words(rng, 9)}", changed(items[0], 7), changed(items[0], 3), " ".join(items[1].split()[:16]), items[2], items[3],
            f"{words(rng, 5)} {items[4]}", items[4][:-1], "", None, words(rng, 300), items[0].upper() + "! " + items[1], " ".join(items[0].split()[5:17]), items[2]]
    for size in (decontaminate.BLOCK_SEEDS, 60):
        got = {(r.id, r.item_id): r.n_words for r in decontaminate.contaminated(frame(docs), "doc_id", "text", bench, "item_id", "text", size).collect()}
        for i, d in enumerate(docs):
            for k, item in enumerate(items):
                own, doc = (item or "").split(), (d or "").lower().replace("!", "").split()
                if k == 5:
                    continue  # a one-word item matches wherever its word stands
                want = brute_overlap(own, doc) if own else 0
                assert got.get((i, k), 0) == want, (i, k)
    assert decontaminate.contaminated(frame([]), "doc_id", "text", bench, "item_id", "text").count() == 0
    assert decontaminate.contaminated(frame(docs), "doc_id", "text", bench.limit(0), "item_id", "text").count() == 0


def test_masks_leave_a_seed_in_every_overlap():
    masks = [int(m[::-1], 2) for m in decontaminate.MASKS]
    for size in range(12, 2 * decontaminate.MIN_WORDS):  # a longer one has a part of this size with the share
        wrong = int(size * (1 - decontaminate.SHARE) + 1e-9)
        kept = np.full(1, (1 << size) - 1)
        for _ in range(wrong):
            kept = np.unique(np.concatenate([kept & ~(1 << i) for i in range(size)]))
        hit = np.zeros(len(kept), bool)
        for m in masks:
            for at in range(size - m.bit_length() + 1):
                hit |= kept & m << at == m << at
        assert hit.all(), (size, int((~hit).sum()))


def test_overlaps_with_substitutions_anywhere(spark, frame):
    rng = random.Random(13)
    items = [words(rng, n) for n in (60, 15, 13, 12)]
    docs = [" ".join("zz" if i % 5 == 4 else w for i, w in enumerate(items[0].split()))]
    docs.append(f"{words(rng, 20)} {docs[0]} {words(rng, 20)}")
    for k in (1, 2, 3):
        size = len(items[k].split())
        for _ in range(60):
            gone = rng.sample(range(1, size - 1), size // 5)
            docs.append(f"{words(rng, rng.randint(0, 3))} {' '.join('zz' if i in gone else w for i, w in enumerate(items[k].split()))}")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.id, r.item_id): r.n_words for r in decontaminate.contaminated(frame(docs), "doc_id", "text", bench, "item_id", "text").collect()}
    for i, d in enumerate(docs):
        for k, item in enumerate(items):
            assert got.get((i, k), 0) == brute_overlap(item.split(), d.split()), (i, k)


def test_queries_give_whole_results(spark):
    got = queries.op4_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert all(len(r.kept_sha256) == 64 for r in got)
    assert {r.kept_sha256 for r in got if r.n_bytes == r.n_removed} <= {hashlib.sha256(b"").hexdigest()}
    assert all(r.first_doc_id < r.doc_id and r.n_words >= 50 for r in queries.op9_compact_windows(spark, "/root/testdata/sf0.001").collect())


def test_matches_do_not_depend_on_the_order_of_their_rows():
    """windows of two functions may have one place; their order came from the shuffle, and passages with it."""
    import itertools

    import pyarrow as pa
    rows = [(0, 95, 100, 105), (1, 60, 100, 140), (2, 120, 130, 135)]
    got = set()
    for order in itertools.permutations(rows):
        fn, left, c, right = map(list, zip(*order, strict=True))
        part = pa.table({"id": [2] * 3, "holder": [1] * 3, "fn": fn, "l": left, "c": c, "r": right, "l0": left, "c0": c, "r0": right, "task": [7] * 3})
        got.add(str(compact_windows._matches(part, least=1, band=100).to_pylist()))
    assert len(got) == 1 and "'task': 7" in got.pop()


def test_matches_verified_together_are_those_verified_alone():
    """a task's matches are told in arrays; shingles that repeat and regions that are not there included."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(8)
    texts = {k: rng.integers(1, 1 << 60, 400).astype(np.uint64) for k in range(12)}
    for k in range(1, 12):
        texts[k][100:260] = texts[0][100:260]
        texts[k][rng.integers(100, 260, k)] = rng.integers(1, 1 << 60, k).astype(np.uint64)
    texts[5][110:140] = texts[5][110]
    texts[6][120:180] = np.tile(texts[0][120:130], 6)
    given = pa.table({"id": [*texts], "stretch": pa.array([0] * 12, pa.int32()), "low": pa.array([0] * 12, pa.int32()), "shingles": [x.tobytes() for x in texts.values()]})
    matches = [(k, j, int(a), int(a) + 20, int(a) + s, int(a) + 20 + s) for j in range(12) for k in range(j + 1, 12) for a, s in ((110, 0), (200, 3))] + [(99, 1, 0, 9, 0, 9), (3, 99, 0, 9, 0, 9)]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
    names = ["id", "holder", "low", "high", "low0", "high0"]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    want = set()
    for k, holder, low, high, low0, high0 in matches[:-2]:
        a, b = max(0, low - 100), max(0, low0 - 100)
        want |= {(k, s, e, holder, score) for s, e, score in compact_windows.verify_passage(texts[k][a:high + 101], a, texts[holder][b:high0 + 101], 0.8)}
    together = compact_windows.Regions(given, 0.8).verify(batch(matches))
    alone = compact_windows.Regions(given, 0.8)
    assert together == want == set().union(*(alone.verify(batch([m])) for m in matches)) and len(want) > 60
