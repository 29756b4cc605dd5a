"""Hard-negative mining over lists shared by clusters of anchors (operator 12).

A row's score for an anchor is the integer inner product of their vectors, each component first floor(scale * x). An
anchor's positives are its best rows of the same label; for each positive, the negatives are the best rows of other
labels whose score lies within shares of the positive's score.

* Anchors are dealt into groups of bounded size and clustered by angle inside a group. Rows are dealt into blocks of
  bounded size. A task gets one group and one block; anchors are a stated query set, so each meets every block.
* For a cluster with centre c and widest angle w, a row r at angle t to c scores at most |u| |r| cos(max(0, t - w)) for
  a member u. The task sorts its rows by that bound once per cluster, and every member walks this list, a stretch at a
  time, until its own k-th best score is above what the next bound allows (or that bound is below the window): then
  nothing further on can count, and the walk ends with a certified result.
* Blocks come in waves, each several times the one before. The k-th best scores after a wave bound the walks of the
  next, so far blocks are left early and give few rows; results are merged by a window per anchor and goal.

Rows without an id, label or vector, or with a null or non-finite component take no part. Rows that share an id are
one row, the one with the smallest (label, vector). Only vectors of equal length are compared; a zero vector scores 0.
Equal scores go to the smaller id. A text column or any other plays no part, an empty table gives an empty result, and
scores must fit in 64 bits, or the job fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, release, saved

BLOCK_BYTES = 16 << 20
GROUP_BYTES = 8 << 20
BLOCK_ROWS = 1024  # blocks are not made smaller than this for more tasks
STRETCH = 256
GROWTH = 4
SLACK = 1e-6  # far above the rounding of angles
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def packed(scale: float):
    """Vectors as packed integers: four bytes a component where those hold them, else eight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            q = np.floor(scale * np.asarray(lists.flatten(), np.float64))
            dims = np.asarray(pc.list_value_length(lists))
            ends = np.cumsum(dims)
            parts = [q[i:j] for i, j in zip((ends - dims).tolist(), ends.tolist(), strict=True)]
            out = [x.astype(np.float32 if np.abs(x).max(initial=0) < 1 << 24 else np.float64).tobytes() for x in parts]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["id", "label", "dims", "q"])
        release()

    return run


def matrix(column: list[bytes], dims: int) -> np.ndarray:
    """Packed vectors of one length as rows of float64."""
    out = np.empty((len(column), dims))
    for i, x in enumerate(column):
        out[i] = np.frombuffer(x, np.float32 if len(x) == 4 * dims else np.float64)
    return out


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((v * v).sum(axis=1))
    return v / np.where(norm > 0, norm, 1)[:, None], norm


def clusters(v: np.ndarray, rounds: int = 3) -> np.ndarray:
    """A cluster of each row by angle: about sqrt(n) centres, first taken at even steps, then moved to their rows' mean."""
    u, _ = unit(v)
    centres = u[:: max(1, int(np.sqrt(len(u))))]
    own = np.zeros(len(u), np.int64)
    for _ in range(rounds):
        own = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, u)
        centres = unit(np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, sums, centres))[0]
    return own


def products(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if u.shape[1] * np.abs(u).max(initial=0) * np.abs(v).max(initial=0) < 1 << 53:
        return u @ v.T
    big = u.astype(np.int64).astype(object) @ v.astype(np.int64).astype(object).T
    if big.size and max(abs(int(big.max())), abs(int(big.min()))) >= 1 << 63:
        raise OverflowError("scores do not fit in 64 bits")
    return big.astype(np.int64)


class Goals:
    """What each member of a cluster looks for: the k best scores within [low, high] that beat the known k-th one."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray, kth: np.ndarray, kth_id: np.ndarray):
        self.k, self.low, self.high = k, low, high  # members x goals
        self.least, self.least_id = kth.copy(), kth_id.copy()
        self.found = {}
        self.open = low <= high

    def take(self, member: int, goal: int, ids: np.ndarray, scores: np.ndarray) -> None:
        held = self.found.get((member, goal))
        if held is not None:
            ids, scores = np.concatenate([held[0], ids]), np.concatenate([held[1], scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.found[member, goal] = ids[best], scores[best]
        if len(best) == self.k:
            s, i = scores[best[-1]], ids[best[-1]]
            if s > self.least[member, goal] or s == self.least[member, goal] and i < self.least_id[member, goal]:
                self.least[member, goal], self.least_id[member, goal] = s, i


def walk(members: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, goals: Goals,
         rows: np.ndarray, row_ids: np.ndarray, row_labels: np.ndarray) -> int:
    """Every member's walk along the cluster's list of ``rows``; fills ``goals`` and returns the products that it took."""
    u, size = unit(members)
    r, length = unit(rows)
    centre = unit(u.sum(axis=0, keepdims=True))[0][0]
    angle = lambda x: np.arccos(np.clip(x @ centre, -1, 1))
    wide = angle(u).max()
    bound = length * (np.cos(np.maximum(0, angle(r) - wide)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    at, step, took = 0, STRETCH, 0
    while at < len(order):
        reach = bound[at] * size + 0.5  # scores are whole numbers
        goals.open &= reach[:, None] >= np.maximum(goals.low, goals.least)
        active = np.flatnonzero(goals.open.any(axis=1))
        if not len(active):
            break
        some = order[at:at + step]
        score = products(members[active], rows[some])
        took += score.size
        fits = (labels[active][:, None] == row_labels[some][None, :]) == same
        fits &= ids[active][:, None] != row_ids[some][None, :]
        for goal in range(goals.low.shape[1]):
            low, high, least, least_id = (x[active, goal][:, None] for x in (goals.low, goals.high, goals.least, goals.least_id))
            mine = fits & goals.open[active, goal][:, None] & (score >= low) & (score <= high)
            mine &= (score > least) | ((score == least) & (row_ids[some][None, :] < least_id))
            for m in np.flatnonzero(mine.any(axis=1)):
                hit = np.flatnonzero(mine[m])
                goals.take(int(active[m]), goal, row_ids[some[hit]], score[m, hit].astype(np.int64))
        at += step
        step = min(2 * step, 16 * STRETCH)
    return took


def task(k: int, same: bool):
    """A group of seekers and a block of rows: (anchor, goal, id, score) of what can still be among the k best."""
    names = ["anchor", "goal", "id", "score"]

    def run(seekers: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        dims, cluster = np.asarray(seekers.column("dims")), np.asarray(seekers.column("cluster"))
        row_dims = np.asarray(rows.column("dims")) if rows.num_rows else np.empty(0, np.int32)
        for d in np.unique(dims):
            block = rows.take(pa.array(np.flatnonzero(row_dims == d)))
            if not block.num_rows:
                continue
            v, row_ids, row_labels = matrix(block.column("q").to_pylist(), int(d)), np.asarray(block.column("id")), np.asarray(block.column("label"))
            for c in np.unique(cluster[dims == d]):
                own = seekers.take(pa.array(np.flatnonzero((dims == d) & (cluster == c))))
                goals = Goals(k, *(np.array(own.column(x).to_pylist(), np.int64).reshape(own.num_rows, -1) for x in ("low", "high", "kth", "kth_id")))
                ids = np.asarray(own.column("anchor"))
                walk(matrix(own.column("q").to_pylist(), int(d)), ids, np.asarray(own.column("label")), same, goals, v, row_ids, row_labels)
                for (m, goal), (found, scores) in goals.found.items():
                    out[0].append(np.full(len(found), ids[m]))
                    out[1].append(np.full(len(found), goal))
                    out[2].append(found)
                    out[3].append(scores)
        release()
        return pa.table({n: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), t) for n, x, t in
                         zip(names, out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)})

    return run


def best(seekers: DataFrame, rows: DataFrame, n_groups: int, n_blocks: int, first: int, k: int, same: bool) -> DataFrame:
    """(anchor, goal, rank, id, score): the k best of every goal of ``seekers`` (with low and high) over all blocks."""
    none = F.transform("low", lambda _: F.lit(LOWEST))
    state, found, at, step = seekers.withColumn("kth", none).withColumn("kth_id", none), None, 0, first
    groups = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    while at < n_blocks:
        end = min(n_blocks, at + step)
        blocks = rows.where((F.col("block") >= at) & (F.col("block") < end)).withColumn("part", groups)
        asked = state.withColumn("of", F.explode(F.sequence(F.lit(at), F.lit(end - 1))))
        new = asked.groupBy("group", "of").cogroup(blocks.groupBy("part", "block")).applyInArrow(task(k, same), "anchor long, goal int, id long, score long")
        merged = new if found is None else new.unionByName(found.drop("rank"))
        order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "id")
        found = saved(merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best-so-far")
        at, step = end, step * GROWTH
        if at < n_blocks:
            full = found.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("goal", F.struct("score", "id")))).alias("known"))
            known = lambda part: F.transform("low", lambda _, i: F.coalesce(F.try_element_at("known", i)[part], F.lit(LOWEST)))
            state = saved(seekers.join(full, "anchor", "left").withColumn("kth", known("score")).withColumn("kth_id", known("id")).drop("known"), "seekers")
    return found


def mine(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score).

    ``is_anchor`` is a condition on the id, as column ``id``. A negative's score lies between ``low`` and ``high``
    percent of the positive's; ``rank`` counts a positive's negatives from 1.
    """
    spark = vectors.sparkSession
    prepare(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = own.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))
    own = own.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    rows = saved(own.mapInArrow(packed(scale), "id long, label long, dims int, q binary"), "packed-vectors")

    picked = rows.where(is_anchor)
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("q") + 24), F.lit(0))).first()
    n_asked, asked = picked.agg(F.count("*"), F.coalesce(F.sum(F.length("q") + 24), F.lit(0))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(1, -(-asked // GROUP_BYTES))
    n_blocks = max(1, -(-size // BLOCK_BYTES), min(tasks, -(-n // BLOCK_ROWS)))
    first = max(tasks, -(-n_blocks // 16))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))

    def clustered(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        dims, out = np.asarray(t.column("dims")), np.zeros(t.num_rows, np.int64)
        for d in np.unique(dims):
            some = np.flatnonzero(dims == d)
            out[some] = clusters(matrix(t.column("q").take(pa.array(some)).to_pylist(), int(d)))
        return t.append_column("cluster", pa.array(out, pa.int64()))

    dealt = picked.select(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n_groups)).cast("int").alias("group"), "id", "label", "dims", "q")
    anchors = saved(dealt.groupBy("group").applyInArrow(clustered, "group int, id long, label long, dims int, q binary, cluster long")
                    .withColumnRenamed("id", "anchor"), "anchors")

    every = anchors.withColumn("low", F.array(F.lit(LOWEST))).withColumn("high", F.array(F.lit(HIGHEST)))
    chosen = best(every, rows, n_groups, n_blocks, first, positives, True)
    goals = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("own"))  # a bounded number of positives
    # exact bounds of the window in whole numbers
    lows = F.transform("own", lambda x: F.ceil(x["score"].cast("decimal(20,0)") * low / 100).cast("long"))
    highs = F.transform("own", lambda x: F.floor(x["score"].cast("decimal(20,0)") * high / 100).cast("long"))
    asking = saved(anchors.join(goals, "anchor").withColumn("low", lows).withColumn("high", highs).drop("own"), "seekers")
    found = best(asking, rows, n_groups, n_blocks, first, negatives, False)
    return (found.select("anchor", (F.col("goal") + 1).alias("p"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative"), F.col("score").alias("negative_score"))
            .join(chosen.select("anchor", F.col("rank").alias("p"), F.col("id").alias("positive"), F.col("score").alias("positive_score")), ["anchor", "p"])
            .select("anchor", "positive", "rank", "negative", "positive_score", "negative_score"))
