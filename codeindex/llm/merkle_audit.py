"""Fixity audit of web archives (operator 5): Merkle trees over ordered offset ranges of WARC files.

``warc_records`` lays out rows as WARC response records, in files of FILE_RECORDS consecutive ids, each with its byte
offset. ``tree`` hashes every record (SHA-256), joins the hashes of a file's records by offset range (RANGE_BYTES) and
then FAN-OUT nodes at a time, up to one root. ``audit`` compares two replicas: it starts at the root and joins the
children of those nodes only whose hashes differ, so a sound replica costs one comparison, and damage is located in
as many steps as the tree has levels. Everything is DataFrame operations; only hashes and places are shuffled.

A record is ``changed`` (other bytes at its place), ``missing`` (not in the replica) or ``extra`` (only there). Null
bodies are empty. Null ids are left out. Rows that repeat an id are records of their own, ordered by their hash. Files
that one replica lacks are nodes without a partner, and so their records are found as well. Empty tables have no root.
Ids may be negative, bodies of any length are one record, and other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FILE_RECORDS = 1000
RANGE_BYTES = 1 << 16
FAN_OUT = 16


def warc_records(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """(id, record string) of each row: a WARC/1.1 response record with its header block."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col(url_col), F.lit("")),
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), F.col(id_col).cast("string"), F.lit(">\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.concat(head, body, F.lit("\r\n\r\n")).alias("record"))


def leaves(records: DataFrame) -> DataFrame:
    """(file, id, turn, size, hash) of each record; ``turn`` tells records of one id apart."""
    hashed = records.select((F.floor(F.col("id") / FILE_RECORDS)).cast("long").alias("file"), "id", F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("hash"))
    return hashed.withColumn("turn", F.row_number().over(Window.partitionBy("id").orderBy("hash")))


def placed(own: DataFrame, manifest: DataFrame) -> DataFrame:
    """Leaves with ``start`` and ``part`` (the offset range) of the manifest; records it lacks come behind its last offset."""
    start = F.sum("size").over(Window.partitionBy("file").orderBy("id", "turn").rowsBetween(Window.unboundedPreceding, -1))
    offsets = manifest.withColumn("start", F.coalesce(start, F.lit(0))).select("file", "id", "turn", "start")
    return (own.join(offsets, ["file", "id", "turn"], "left")
            .withColumn("part", F.coalesce(F.floor(F.col("start") / RANGE_BYTES), F.lit(1 << 40)).cast("long")))


def _joined(order: list[str], hash_col: str) -> Column:
    return F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(*order, hash_col))), lambda x: x[hash_col])), 256)


def tree(places: DataFrame) -> list[DataFrame]:
    """Levels from records up: records (file, part, id, turn, hash), ranges, files, groups of files ..., the root."""
    levels = [places.select("file", "part", "id", "turn", "start", "size", "hash")]
    ranges = places.groupBy("file", "part").agg(_joined(["id", "turn"], "hash").alias("hash"))
    levels.append(ranges)
    # ranges of a file: at most FILE_RECORDS of them
    files = ranges.groupBy("file").agg(_joined(["part"], "hash").alias("hash")).select(F.col("file").alias("node"), "hash")
    levels.append(saved(files, "merkle-files"))
    return levels


def raised(level: DataFrame) -> DataFrame:
    return level.groupBy(F.floor(F.col("node") / FAN_OUT).cast("long").alias("up")).agg(_joined(["node"], "hash").alias("hash")).select(F.col("up").alias("node"), "hash")


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    other = b.select(*keys, F.col("hash").alias("other"))
    return a.join(other, keys, "full").where(~F.col("hash").eqNullSafe(F.col("other")))


def audit(records: DataFrame, replica: DataFrame) -> DataFrame:
    """(id, file, start, size, status, hash, replica_hash) of every record in which the replica differs."""
    own, theirs = leaves(records), leaves(replica)
    own = saved(own, "merkle-leaves")
    theirs = saved(theirs, "merkle-leaves")
    a, b = tree(placed(own, own)), tree(placed(theirs, own))
    base, high = a[2].unionByName(b[2]).agg(F.min("node"), F.max("node")).first()
    # nodes count from 0 for the first file, as ids of both signs would never meet under one root
    low, high, base = (None, None, 0) if base is None else (0, high - base, base)
    tops = [tuple(x[2].withColumn("node", F.col("node") - base) for x in (a, b))]
    while low is not None and low != high:  # log(files) levels, up to one root
        x, y = raised(tops[-1][0]), raised(tops[-1][1])
        tops.append((saved(x, "merkle-level"), saved(y, "merkle-level")))
        low, high = low // FAN_OUT, high // FAN_OUT
    # down again: children of differing nodes only
    wrong = _differing(*tops[-1], ["node"]).select("node")
    for x, y in reversed(tops[:-1]):
        up = F.floor(F.col("node") / FAN_OUT).cast("long")
        wrong = saved(wrong, "merkle-differing").withColumnRenamed("node", "up")
        x, y = (z.withColumn("up", up).join(wrong, "up", "left_semi").drop("up") for z in (x, y))
        wrong = _differing(x, y, ["node"]).select("node")
    wrong = saved(wrong.select((F.col("node") + base).alias("file")), "merkle-differing")
    parts = saved(_differing(*(z[1].join(wrong, "file", "left_semi") for z in (a, b)), ["file", "part"]).select("file", "part"), "merkle-differing")
    x, y = (z[0].join(parts, ["file", "part"], "left_semi") for z in (a, b))
    y = y.select("file", "id", "turn", F.col("size").alias("replica_size"), F.col("hash").alias("replica_hash"))
    return (x.join(y, ["file", "id", "turn"], "full").where(~F.col("hash").eqNullSafe(F.col("replica_hash")))
            .select("id", "file", "start", F.coalesce("size", "replica_size").alias("size"),
                    F.when(F.col("hash").isNull(), "extra").when(F.col("replica_hash").isNull(), "missing").otherwise("changed").alias("status"), "hash", "replica_hash"))
