"""Operator 13 against plain Python: permutation, computable places, shard sizes, whole rows in files."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codeindex.llm import sharding
from llm_frames import frame  # noqa: F401  (a fixture)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 16, 17, 31, 90, 257, 1000])
def test_network_is_a_permutation_with_an_inverse(n):
    places = [sharding.place_of(k, n, 4) for k in range(n)]
    assert sorted(slot * 4 + shard for shard, slot in places) == list(range(n))
    assert [sharding.row_of(*p, n, 4) for p in places] == list(range(n))


def test_halves_leave_little_to_walk():
    for n in [1, 2, 3, 50, 99, 100, 101, 12345, 10**12 + 7]:
        a, b = sharding.halves(n)
        assert n <= a * b < n + a


@pytest.mark.parametrize("n", [1, 7, 90, 1000])
def test_columns_equal_plain_python(spark, n):
    rows = sharding.permuted(spark.range(n), "id", "place", n).collect()
    assert all((r["place"] % 16, r["place"] // 16) == sharding.place_of(r["id"], n) for r in rows)


def test_shards_of_odd_rows(frame):
    texts = ["a", None, "", "é" * 30000, "same", "same", *["hot"] * 300, *[f"t{i}" for i in range(100)]]
    ids = [5, 5, 5, None, None, None, *[9] * 300, *range(100, 200)]
    rows = sharding.shards(frame(texts, ids), "doc_id", "text").collect()
    n = len(texts)
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    assert sorted(r["slot"] * 16 + r["shard"] for r in rows) == list(range(n))
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    null_first = {r["slot"] * 16 + r["shard"] for r in rows if r["id"] is None}
    assert null_first == {slot * 16 + shard for shard, slot in (sharding.place_of(k, n) for k in range(3))}


def test_layout_of_the_table_does_not_matter(frame):
    df = frame([f"text {i % 50}" for i in range(400)], [i % 37 for i in range(400)])
    one = Counter(map(tuple, sharding.shards(df.coalesce(1), "doc_id", "text").collect()))
    assert one == Counter(map(tuple, sharding.shards(df.repartition(13, F.rand(3)), "doc_id", "text").collect()))


def test_empty_table(frame):
    assert sharding.shards(frame([]), "doc_id", "text").count() == 0


def test_files_hold_whole_rows_in_slot_order(spark, frame, tmp_path):
    df = frame([f"text {i}" for i in range(100)])
    sharding.write_shards(df, "doc_id", "text", str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("row.*").collect())) == sorted(map(tuple, df.collect()))
    for r in back.select("shard", "slot", "row.doc_id").collect():
        assert (r["shard"], r["slot"]) == sharding.place_of(r["doc_id"], 100, 3)
