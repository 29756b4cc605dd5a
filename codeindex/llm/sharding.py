"""A reproducible shuffle with computable shard and slot (operator 13), in DataFrame functions only.

Rows are numbered 0 to n-1 in the order of (id, text hash), which does not depend on how the table is laid out. A
Feistel network over pairs (l, r) with l < a, r < b and a*b just over n permutes the numbers: each round adds a keyed
hash of one half to the other. A result of n or more goes through the network again until it is below n (cycle
walking; at most a*b - n times, as the network never repeats a result on the way), so the map is a permutation of 0
to n-1. Place p lies in shard ``p mod shards`` at slot ``p div shards``: shards differ by one row at most, slots have
no gaps, and n, seed and shard count alone tell the shard and slot of a row number (``permuted``, ``place_of``) and
the row number at a shard's slot (``row_of``).

Numbering sorts narrow rows (id, size, hashes) by ranges, writes them with their place in the range, and adds up the
ranges' sizes: texts are not shuffled and no task sees all rows.

Nulls: null ids come first; a null text has no bytes, so size 1 and checksum 0. Rows that share id and text are equal
rows: each has a place of its own, and which of them stands where makes no difference. Hot ids or texts need no rule,
as ranges are cut by id, hash and place in the input. An empty table gives an empty one; a text of any length counts
as its size and hashes; other columns, whatever their names, take part only where ``carry`` asks for whole rows.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

ROUNDS = 8
SHARDS = 16
SEED = 20240607
_IN_RANGE = (1 << 33) - 1  # the low bits of monotonically_increasing_id() count a partition's rows


def halves(n: int) -> tuple[int, int]:
    """Sizes a and b of the two halves: a*b is at least n and below n + a."""
    a = isqrt(max(0, n - 1)) + 1
    return a, max(1, -(-n // a))


def _long(x) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("long")


def _hash(x: Column, i: Column, seed: int) -> Column:
    """A keyed hash of a half: the first 60 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), i.cast("string"), F.lit(":"), x.cast("string")))
    return _long(F.conv(F.substring(digest, 1, 15), 16, 10))


def _network(x: Column, n: int, seed: int) -> Column:
    """``x`` once through all rounds, as a fold over the round numbers."""
    a, b = (_long(v) for v in halves(n))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        added = _hash(F.when(even, s["r"]).otherwise(s["l"]), i, seed)
        return F.struct(F.when(even, (s["l"] + added) % a).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise((s["r"] + added) % b).alias("r"))

    start = F.struct((x % a).alias("l"), F.call_function("div", x, a).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] + s["r"] * a)


def permuted(df: DataFrame, number: str, out: str, n: int, seed: int = SEED) -> DataFrame:
    """``df`` with the place of the row number in column ``number`` (below ``n``) as column ``out``."""
    a, b = halves(n)
    once = df.withColumn(out, _network(F.col(number), n, seed))
    if a * b == n:
        return once
    tries = F.sequence(_long(1), F.when(F.col(out) >= n, _long(a * b - n)))  # made for the few rows that need it, not folded into the plan
    walked = F.aggregate(tries, F.col(out), lambda p, _: F.when(p < n, p).otherwise(_network(p, n, seed)))
    return once.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(walked))


def _added(x: int, i: int, seed: int) -> int:
    return int(hashlib.md5(f"{seed}:{i}:{x}".encode()).hexdigest()[:15], 16)


def place_of(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row number, without the table."""
    a, b = halves(n)
    while True:
        r, left = divmod(row, a)
        for i in range(ROUNDS):
            left, r = (left, (r + _added(left, i, seed)) % b) if i % 2 else ((left + _added(r, i, seed)) % a, r)
        row = left + r * a
        if row < n:
            return row % shards, row // shards


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that stands at a shard's slot: the rounds backwards."""
    a, b = halves(n)
    place = slot * shards + shard
    while True:
        r, left = divmod(place, a)
        for i in reversed(range(ROUNDS)):
            left, r = (left, (r - _added(left, i, seed)) % b) if i % 2 else ((left - _added(r, i, seed)) % a, r)
        place = left + r * a
        if place < n:
            return place


def numbered(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> tuple[DataFrame, int]:
    """(id, size, text_crc32, number [, row]) of every row, and how many there are; ``row``: all columns as a struct."""
    text = F.col(text_col)
    own = [F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
           F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("hash"),
           text.isNull().alias("none"), F.monotonically_increasing_id().alias("at")]
    order = ["id", "hash", "none", "at"]
    rows = docs.select(*own, *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = saved(placed.select("id", "size", "text_crc32", F.shiftright("at", 33).cast("int").alias("part"),
                                 F.col("at").bitwiseAND(_IN_RANGE).alias("at"), *(["row"] if carry else [])), "row-numbers")
    # one row per partition
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = saved(sizes.select("part", F.coalesce(F.sum("n").over(before), _long(0)).alias("base")), "range-starts")
    joined = placed.join(base, "part").withColumn("number", F.col("base") + F.col("at"))
    return joined.select("id", "size", "text_crc32", "number", *(["row"] if carry else [])), placed.count()


def shards(docs: DataFrame, id_col: str, text_col: str, shards: int = SHARDS, seed: int = SEED, carry: bool = False) -> DataFrame:
    """(id, size, text_crc32, shard, slot [, row]) of every row."""
    rows, n = numbered(docs, id_col, text_col, carry)
    return (permuted(rows, "number", "place", n, seed)
            .withColumn("shard", (F.col("place") % shards).cast("int")).withColumn("slot", F.call_function("div", F.col("place"), _long(shards)))
            .drop("number", "place"))


def write_shards(docs: DataFrame, id_col: str, text_col: str, path: str, shards_: int = SHARDS, seed: int = SEED) -> None:
    """The whole rows as Parquet folders ``shard=k`` below ``path``, in files of ascending slots."""
    rows = shards(docs, id_col, text_col, shards_, seed, carry=True)
    (rows.select("shard", "slot", "row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
