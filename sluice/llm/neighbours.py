"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected to a few dimensions in several ways, each with its own rotation and shift, and every projection
is laid along a Hilbert curve.  Each curve is range-partitioned and cut into blocks of one window of vectors; a query meets its
own block and the two beside it on every curve.  Candidates of all curves merge and are reranked by exact inner
products in double precision.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

#: The share of true neighbours that a search must find, and the most queries by which each run measures it.
RECALL, PROBES = 0.9, 128


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows), each coordinate of `bits` bits (Skilling's transform)."""
    x = cells.astype(np.uint64).T.copy()
    d = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > 1:
        p = q - one
        for i in range(d):
            high = (x[i] & q) != 0
            t = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= one
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


class Curves:
    """`count` projections of unit-length directions to `dims` dimensions, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, count: int, dims: int, bits: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        n, width = sample.shape
        self.bits, self.dims = bits, min(dims, width)
        self.mean = sample.mean(0) if n else np.zeros(width)
        spread = np.linalg.svd(sample - self.mean, full_matrices=False)[2] if n > 1 else np.eye(width)
        main = spread[: min(len(spread), 4 * self.dims)]
        self.axes, self.low, self.step, self.shift = [], [], [], []
        for _ in range(count):
            turn = np.linalg.qr(rng.normal(size=(len(main), len(main))))[0][:, : self.dims]
            axes = main.T @ turn
            y = (sample - self.mean) @ axes if n else np.zeros((1, axes.shape[1]))
            low, high = y.min(0), y.max(0)
            self.axes.append(axes)
            self.low.append(low)
            # the curve covers twice the sample's range, and its place there is shifted at random
            self.step.append(np.maximum(high - low, 1e-9) * 2 / (1 << bits))
            self.shift.append(rng.uniform(0, 0.5, axes.shape[1]) * (1 << bits))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, low, step, shift in zip(self.axes, self.low, self.step, self.shift):
            cells = np.clip(((vectors - self.mean) @ axes - low) / step + shift, 0, (1 << self.bits) - 1)
            out.append(hilbert_keys(cells.astype(np.int64), self.bits))
        return out


class Nearest:
    """The m points of greatest inner product, for each of some queries, of all points shown so far."""

    def __init__(self, qid: np.ndarray, queries: np.ndarray, m: int):
        self.qid, self.queries = qid, queries
        self.score = np.full((len(queries), m), -np.inf)
        self.at = np.full((len(queries), m), -1)  # which of the points held; none: -1
        self.pid, self.first, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.list_(pa.int64()))

    def show(self, pid: np.ndarray, p: np.ndarray, ids: pa.Array) -> None:
        (n, width), m, held = p.shape, self.score.shape[1], len(self.pid)
        self.pid = np.append(self.pid, pid)
        self.first = np.append(self.first, pc.list_element(ids, 0).to_numpy())
        slack = 1e-12 * np.abs(p).max() * width
        for lo in range(0, len(self.queries), 256):
            some, score, at = (x[lo : lo + 256] for x in (self.queries, self.score, self.at))
            near = some @ p.T
            least = score[:, -1]
            if np.isneginf(least).any():
                few = min(m, n)
                least = np.maximum(least, np.partition(near, n - few, axis=1)[:, n - few])
            # all that rounding could put among the m nearest
            a, b = np.nonzero(near >= (least - slack * np.abs(some).max(1))[:, None])
            # the score itself, summed in component order for every pair alike
            exact = np.zeros(len(a))
            for i in range(width):
                exact += some[a, i] * p[b, i]
            old = np.nonzero(at >= 0)
            a, exact, b = np.append(old[0], a), np.append(score[old], exact), np.append(at[old], b + held)
            order = np.lexsort((self.first[b], -exact, a))
            a, exact, b = a[order], exact[order], b[order]
            nth = np.arange(len(a)) - np.searchsorted(a, a)
            kept = nth < m
            score[a[kept], nth[kept]], at[a[kept], nth[kept]] = exact[kept], b[kept]
        used = np.unique(self.at[self.at >= 0])
        self.at = np.where(self.at >= 0, np.searchsorted(used, self.at), -1)
        # a copy of what stays, so that the batch can go
        self.pid, self.first, self.ids = self.pid[used], self.first[used], pa.concat_arrays([self.ids, ids]).take(pa.array(used))

    def rows(self) -> pa.RecordBatch:
        a, nth = np.nonzero(self.at >= 0)
        at = self.at[a, nth]
        return pa.RecordBatch.from_arrays([pa.array(self.qid[a]), pa.array(self.pid[at]), pa.array(self.score[a, nth]), self.ids.take(pa.array(at))], ["qid", "pid", "score", "ids"])


def sound_vectors(table: DataFrame, vec: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part: an id, components all finite, not all zero."""
    v = F.col(vec).alias("v")  # in its own precision until it is multiplied
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & ((F.abs(x.cast("double")) < float("inf"))))
    return table.select(F.col(vec_id).cast("long").alias("vec_id"), v).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def window_for(probes: list[tuple[list[int], list[int]]], least: int = 1, recall: float = RECALL) -> tuple[int, float]:
    """The least window, and its measured recall, that meets `recall` with two standard errors to spare.

    A probe is how far off its true neighbours stand (the least over the curves) and how many ids each stands for."""
    windows = sorted({least, *(d for away, _ in probes for d in away if d > least)})

    def measure(window):
        got = np.array([np.dot(np.array(away) <= window, n) / max(sum(n), 1) for away, n in probes if sum(n)])
        return (got.mean(), got.mean() - 2 * got.std() / len(got) ** 0.5) if len(got) else (1.0, 1.0)

    lo, hi = 0, len(windows) - 1
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if measure(windows[mid])[1] >= recall else (mid + 1, hi)
    return windows[lo], float(measure(windows[lo])[0])


def search(table: DataFrame, k: int = 20, every: int = 20, curves: int = 16, dims: int = 9, bits: int = 6, window: int = 64, sample: int = 5000, vec: str = "embedding", vec_id: str = "vec_id", report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose vec_id divides by `every`, its k nearest by inner product.

    Vectors that are null, zero, or hold null or non-finite components take no part; neither do rows without an id or of
    another length than most of the sample.  Rows of equal vectors are one point with its k + 1 least ids, so ties come
    out by id exactly, among distinct vectors too, and repeated rows (same id and vector) count once.  Ids should be
    unique; where they are not, each of an id's vectors is a candidate and its best score counts.  An empty table gives
    no rows.

    A curve is cut into blocks of a window of points, and a query meets its own block and both neighbours on each.  The
    window is measured in each run: at most PROBES of the queries are compared with all points, and of the windows from
    `window` on the least is taken that meets RECALL of their true neighbours with two standard errors to spare.  It
    grows with the table where groups of vectors overlap in the projections: for groups of 25 in 64 dimensions a query
    met 0.041 of 100,000 and 0.041 of 200,000 points.  For evenly spread vectors of many dimensions no curve is short.
    Where the windows of all curves would meet as many points as there are, a query meets every point once instead and
    the answer is exact.  Scores are then queries times points; points pass by bundles of queries, and of a query each
    task gives one list, so the rows that leave grow with the queries alone.
    report, if given, takes window, recall and share (points met, at most, over all points); they go to the log too.
    sample: the most rows on which directions of spread are fitted, by a hash; every row is indexed."""
    spark = table.sparkSession
    rows = sound_vectors(table, vec, vec_id)
    rows = rows.withColumn("h", F.xxhash64("v")).withColumn("g", F.xxhash64(F.lit(1), "v"))
    # the least ids of each distinct vector; Spark limits each group before and after the shuffle
    first = Window.partitionBy("h", "g").orderBy("vec_id")
    ids = rows.dropDuplicates(["h", "g", "vec_id"]).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    points = stored(ids.groupBy("h", "g").agg(F.min("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.xxhash64("h", "g").alias("pid"), "v", "ids"), "points")
    total = points.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    part = points.where(F.col("pid").cast("double") / 2.0**64 + 0.5 <= min(1.0, 1.5 * sample / total)).select("pid", "v").orderBy("pid").limit(sample)
    known = [r["v"] for r in part.collect()] or [points.orderBy("pid").first()["v"]]
    lengths = [len(v) for v in known]
    width = max(set(lengths), key=lambda n: (lengths.count(n), n))
    points = points.where(F.size("v") == width)
    held = np.array([v for v in known if len(v) == width], float)
    kind = points.schema["v"].dataType.simpleString()
    # greatest inner product is nearest in angle once a further component evens out the lengths of the points; in a query
    # that component is 0, so it is looked up elsewhere than at its own point
    longest = float(points.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()[0] or 0.0)
    even = lambda a: np.c_[a, np.sqrt(np.maximum(longest - (a * a).sum(1), 0))]
    asking = lambda a: np.c_[a * np.sqrt(longest / (a * a).sum(1, keepdims=True)), np.zeros(len(a))]
    whole = 3 * curves * window >= total
    laid = Curves(even(held), 1 if whole else curves, dims, bits)

    def place(batches):
        for b in batches:
            v = np.array(b.column(1).flatten(), float).reshape(-1, width)
            lifted = asking(v) if b.schema.names[2] == "asks" else even(v)
            ids = pa.nulls(len(v), pa.list_(pa.int64())) if b.schema.names[2] == "asks" else b.column(2)
            for c, key in enumerate(laid.keys(lifted)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(key.astype(np.int64)), b.column(0), b.column(1), ids], ["curve", "key", "pid", "v", "ids"])

    def number(batches):
        # nth: how many points come before on this curve and partition; a row without ids is a query and no point
        at, part = {}, TaskContext.get().partitionId()
        for b in batches:
            curve, point = b.column(0).to_numpy(), b.column(4).is_valid().to_numpy(zero_copy_only=False)
            nth = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                own = curve == c
                upto = at.get(c, 0) + np.cumsum(point[own])
                nth[own] = upto - point[own]
                at[c] = int(upto[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(curve), part, np.int32)), pa.array(nth), b.column(2), b.column(3), b.column(4)], ["curve", "part", "nth", "pid", "v", "ids"])

    n = partitions(spark)
    # equal vectors share their candidates, so a query is a distinct vector with the ids that ask
    queries = rows.where(F.col("vec_id") % every == 0).select(F.xxhash64("h", "g").alias("pid"), "vec_id").distinct()
    asks = points.join(queries.select("pid").distinct(), "pid", "left_semi").select("pid", "v", F.lit(True).alias("asks"))
    placed = f"curve int, key long, pid long, v {kind}, ids array<long>"
    spread = points.select("pid", "v", "ids").mapInArrow(place, placed).unionByName(asks.mapInArrow(place, placed))
    ranged = spread.repartitionByRange(n, "curve", "key", "pid").sortWithinPartitions("curve", "key", "pid")
    numbered = stored(ranged.mapInArrow(number, f"curve int, part int, nth long, pid long, v {kind}, ids array<long>"), "curves")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = numbered.groupBy("curve", "part").agg(F.count("ids").alias("count")).select("curve", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    at = numbered.join(F.broadcast(firsts), ["curve", "part"])  # a row for each curve and partition
    at = at.withColumn("place", F.col("first") + F.col("nth")).select("curve", "place", "pid", "v", "ids")
    block, found = window, 1.0
    if not whole:
        block, found = window_for(_probed(points, asks, at, k, width), window)
        whole = 3 * curves * block >= total
        at = at.where("curve = 0") if whole else at
    if whole:
        block, found = total, 1.0
    facts = {"window": block, "recall": found, "share": 1.0 if whole else 3 * curves * block / total}
    (report if report is not None else {}).update(facts)
    logging.getLogger(__name__).info("%d points on %d curves: %s", total, 1 if whole else curves, facts)
    asked, shown = at.where("ids is null"), at.where("ids is not null")
    if whole:
        # bundles of queries, of some 2^20 components, meet the points slice by slice
        bundles = max(1, math.ceil(asked.count() / max(256, 2**20 // width)))
        slices = max(1, min(4 * n, total // 1024))
        shown = shown.withColumn("part", F.floor(F.col("place") * slices / total)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))))
        asked = asked.withColumn("block", F.pmod(F.xxhash64("pid"), F.lit(bundles))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    else:
        shown, asked = (x.withColumn("block", F.floor(F.col("place") / block)).withColumn("part", F.lit(0).cast("long")) for x in (shown, asked))
        asked = asked.withColumn("block", F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1)))
    met = shown.select("curve", "block", "part", "pid", "v", "ids").unionByName(asked.select("curve", "block", "part", "pid", "v", "ids"))

    def meet(batches):
        # the queries of a block (with each slice anew) come before its points, so points stream past; a query's list
        # leaves the task once, however many slices the task has
        key, qid, q, best = None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(5).is_valid().to_numpy(zero_copy_only=False)]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                some = b.slice(lo, hi - lo)
                pid, v = some.column(3).to_numpy(), np.array(some.column(4).flatten(), float).reshape(-1, width)
                if key != (columns[0][lo], columns[1][lo]):
                    if best:
                        yield best.rows()
                    key, qid, q, best = (columns[0][lo], columns[1][lo]), [], [], None
                if not columns[2][lo]:
                    new = np.append(not qid or pid[0] != qid[-1][-1], pid[1:] != pid[:-1])
                    if new.any():
                        qid.append(pid[new])
                        q.append(v[new])
                elif qid:
                    best = best or Nearest(np.concatenate(qid), np.concatenate(q), k + 1)
                    best.show(pid, v, some.column(5))
        if best:
            yield best.rows()

    dealt = met.repartition(n, "curve", "block", "part").sortWithinPartitions("curve", "block", F.col("ids").isNotNull(), "pid")
    found = dealt.mapInArrow(meet, "qid long, pid long, score double, ids array<long>")
    pairs = found.groupBy("qid", "pid").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    nearest = Window.partitionBy("qid").orderBy(F.desc("score"), F.element_at("ids", 1))
    # k + 1 points hold the k nearest ids, for a point may be the query alone
    few = pairs.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1)
    listed = few.select("qid", "score", F.explode("ids").alias("vec_id"))
    top = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    once = listed.groupBy("qid", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
    lists = once.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    answers = queries.withColumnRenamed("vec_id", "query_id").join(lists, queries["pid"] == lists["qid"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = answers.select("query_id", F.posexplode(others).alias("i", "x"))
    return out.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _probed(points: DataFrame, asks: DataFrame, at: DataFrame, k: int, width: int) -> list[tuple[list[int], list[int]]]:
    """For at most PROBES queries, how many points off their k true neighbours are and how many ids each point gives."""
    asked = asks.orderBy(F.xxhash64("pid"), "pid").limit(PROBES).collect()
    if not asked:
        return []
    qid, q = np.array([r["pid"] for r in asked]), np.array([r["v"] for r in asked], float)

    def meet(batches):
        for b in batches:
            if not b.num_rows:
                continue
            near = q @ np.array(b.column(1).flatten(), float).reshape(-1, width).T
            m = min(k + 1, b.num_rows)
            best = np.argpartition(-near, m - 1, axis=1)[:, :m]
            a = np.repeat(np.arange(len(q)), m)
            yield pa.RecordBatch.from_arrays([pa.array(qid[a]), b.column(0).take(pa.array(best.ravel())), pa.array(near[a, best.ravel()]), b.column(2).take(pa.array(best.ravel()))], ["qid", "pid", "score", "n"])

    nearest = Window.partitionBy("qid").orderBy(F.desc("score"), "pid")
    met = points.select("pid", "v", F.size("ids").alias("n")).mapInArrow(meet, "qid long, pid long, score double, n int")
    true: dict[int, list] = {}
    for r in met.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1).orderBy("qid", "r").collect():
        true.setdefault(r["qid"], []).append((r["pid"], r["n"]))
    pids = at.sparkSession.createDataFrame([(p,) for p in {p for x in true.values() for p, _ in x} | set(true)], "pid long")
    point, place = {}, {}
    for r in at.select("pid", "curve", "place", F.col("ids").isNotNull().alias("point")).join(F.broadcast(pids), "pid").collect():
        (point if r["point"] else place).setdefault(r["pid"], {})[r["curve"]] = r["place"]
    out = []
    for i, near in true.items():
        away, counts, left = [], [], k
        for p, n in near:
            n = min(left, n - (p == i))  # an id is no neighbour of itself
            if n > 0:
                away.append(min(abs(point[p][c] - b) for c, b in place[i].items()))
                counts.append(n)
                left -= n
        out.append((away, counts))
    return out
