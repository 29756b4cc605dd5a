"""Near-duplicate vectors (operator 8) by a pivot-permutation index.

Every vector is described by its PREFIX nearest of PIVOTS reference points, in order. The inverted lists are kept for
pairs of reference points: a vector is on the list of each pair of its nearest ones, so two vectors meet on a list
exactly if they share two of them. Candidates of a list are verified by cosine in double precision, in blocks of at
most BLOCK vectors per side, and a pair is counted on the smallest of the lists that it shares. So every link is
counted once, only counts and a spanning forest leave a task, and a list of any length is dealt out over tasks.

Vectors with equal components form a class first and are indexed once. Reference points are PIVOTS directions of a
sample of SAMPLE times as many, drawn by a hash: each is further than cosine APART from those before it, as many points
inside one group of near vectors would be near to its members in nearly random order. Fewer points are taken where
there are not enough directions. Every vector is indexed. Recall against brute force is measured in the tests.

Null or zero vectors and those with null or non-finite components link with nothing; each is its own component. Vectors
of one length have reference points and lists of their own, as those of different lengths never link. Null ids are left
out; rows that repeat an id are one vector, the smallest. Ties between reference points go to the smaller one, an
empty table gives an empty one, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_groups, prepare, release, saved
from .components import components

PIVOTS = 96
SAMPLE = 16
APART = 0.8
PREFIX = 6
COSINE = 0.9
BLOCK = 512


def _pairs(prefix: np.ndarray, pivots: int) -> np.ndarray:
    """The lists of each vector: every unordered pair of its nearest pivots, as one number (rows x pairs)."""
    i, j = np.triu_indices(prefix.shape[1], 1)
    a, b = prefix[:, i], prefix[:, j]
    return np.minimum(a, b).astype(np.int64) * pivots + np.maximum(a, b)


def describe(vectors: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The nearest pivots of each unit vector, nearest first (ties: the smaller pivot)."""
    close = vectors @ pivots.T
    return np.argsort(-close, axis=1, kind="stable")[:, :prefix].astype(np.int16)


def spread(sample: np.ndarray, n: int, apart: float = APART) -> np.ndarray:
    """The first ``n`` of the unit vectors that are further than cosine ``apart`` from those taken before them."""
    free, out = np.ones(len(sample), bool), []
    for i, x in enumerate(sample):
        if free[i]:
            out.append(i)
            free &= sample @ x < apart
            if len(out) == n:
                break
    return sample[out]


def normal(v: np.ndarray) -> np.ndarray:
    length = np.sqrt((v * v).sum())
    if not np.isfinite(length):
        v = v / np.abs(v).max()
        length = np.sqrt((v * v).sum())
    return v / length


def unit(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Which rows are vectors that can link, their unit vectors in double precision, and the vectors themselves."""
    rows, out, raw = [], [], []
    for i, x in enumerate(lists.to_pylist()):
        if x and None not in x:
            v = np.array(x, np.float64)
            if np.isfinite(v).all() and v.any():
                rows.append(i)
                out.append(normal(v))
                raw.append(v)
    return np.array(rows, np.int64), out, raw


def packed(v: np.ndarray) -> bytes:
    """A vector's bytes, in single precision where that holds it."""
    with np.errstate(over="ignore"):
        single = v.astype(np.float32)
    return (single if (single == v).all() else v).tobytes()


def near_duplicates(vectors: DataFrame, id_col: str, vector_col: str, cosine: float = COSINE, n_pivots: int = PIVOTS) -> DataFrame:
    """(id, n_links, component) of every id."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null")
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    plain = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(plain, F.lit(False))
    hashed = rows.select("id", F.when(usable, F.col("v")).alias("v"), F.when(usable, F.md5(F.concat_ws(",", F.col("v").cast("array<string>")))).alias("same"))
    hashed = saved(hashed, "vectors")
    classes = hashed.where("same is not null").groupBy("same").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    named = saved(hashed.select("id", "same").join(classes, "same", "left").select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies")), "vector-classes")
    reps = hashed.where("v is not null").join(named.where("id = rep").select("id", "copies"), "id")

    # a bounded sample of every vector length
    drawn = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("id", F.lit(5)), "id")
    sample = reps.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= SAMPLE * n_pivots).orderBy("n").select("v")
    groups: dict[int, list[np.ndarray]] = {}
    for v in unit(sample.toArrow().column("v").combine_chunks())[1]:
        groups.setdefault(len(v), []).append(v)
    # of every length, its turn and its reference points
    pivots = spark.sparkContext.broadcast({width: (turn, spread(np.stack(groups[width]), n_pivots)) for turn, width in enumerate(sorted(groups))})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                b = batch.slice(at, 2000)
                rows, units, raw = unit(b.column("v"))
                for width in sorted({len(x) for x in units}):
                    own = [i for i, x in enumerate(units) if len(x) == width]
                    turn, points = pivots.value[width]
                    n = min(PREFIX, len(points))
                    which = rows[own]
                    prefix = describe(np.stack([units[i] for i in own]), points, n)
                    lists = (_pairs(prefix, len(points)) if n > 1 else prefix.astype(np.int64)) + (turn << 32)
                    ids, copies = np.asarray(b.column("id"))[which], np.asarray(b.column("copies"))[which]
                    held, near = [packed(raw[i]) for i in own], [x.tobytes() for x in prefix]
                    dims = pa.array(np.full(len(own), width, np.int32))
                    for k in range(lists.shape[1]):
                        yield pa.RecordBatch.from_arrays([pa.array(lists[:, k]), pa.array(ids), pa.array(copies), pa.array(near, pa.binary()), dims, pa.array(held, pa.binary())],
                                                         ["list", "id", "copies", "near", "dims", "v"])
        release()

    entries = saved(reps.mapInArrow(index, "list long, id long, copies long, near binary, dims int, v binary"), "pivot-lists")
    sizes = entries.groupBy("list").agg(F.count("*").alias("n")).where("n > 1").select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    parts = (entries.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")).drop("other", "blocks"))

    def verify(part: pa.Table) -> pa.RecordBatch:
        p, q, own = (part.column(c)[0].as_py() for c in ("p", "q", "list"))
        ids = np.asarray(part.column("id"))
        order = np.argsort(ids, kind="stable")
        ids, block, copies = ids[order], np.asarray(part.column("block"))[order], np.asarray(part.column("copies"))[order]
        width = part.column("dims")[0].as_py()
        v = np.stack([normal(np.frombuffer(x, np.float32 if len(x) == 4 * width else np.float64).astype(np.float64)) for x in part.column("v").to_pylist()])[order]
        near = np.frombuffer(b"".join(part.column("near").to_pylist()), np.int16).reshape(len(ids), -1)[order]
        linked = np.triu(v @ v.T >= cosine, 1)
        if p != q:
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(linked)
        if len(a) and near.shape[1] > 1:
            # the smallest list of the pair: the two smallest pivots that both are near to
            mine, theirs = np.sort(near, axis=1)[a], near[b]
            common = (mine[:, :, None] == theirs[:, None, :]).any(axis=2)
            rank = np.cumsum(common, axis=1)
            low = mine[np.arange(len(a)), (common & (rank == 1)).argmax(axis=1)].astype(np.int64)
            high = mine[np.arange(len(a)), (common & (rank == 2)).argmax(axis=1)].astype(np.int64)
            here = low * len(pivots.value[width][1]) + high == own & 0xFFFFFFFF
            a, b = a[here], b[here]
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        # a spanning forest: each round hangs roots below smaller ones
        label = np.arange(len(ids))
        while len(a):
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            if (new == label).all():
                break
            label = new
        some = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[label[some]])], ["id", "links", "least"])

    found = saved(by_groups(parts, ["list", "p", "q"], verify, "id long, links long, least long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.where("least <> id").select(F.col("id").alias("a"), F.col("least").alias("b")))
    return (named.join(links.withColumnRenamed("id", "rep"), "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
            .select("id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")))
