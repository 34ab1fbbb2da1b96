"""Approximate nearest neighbours by balanced posting lists.

Largest inner product becomes smallest distance by one more coordinate, sqrt(M^2 - |x|^2) with M
the largest norm; queries are scaled to norm M and get 0. Centroids come from a bounded sample,
split until no cluster holds more than its share, and are searched by a beam over an in-memory
neighbour graph. A vector goes to every list whose centroid is nearly as near as its nearest
(boundary vectors are replicated); a query opens the lists whose distance ratio to its nearest
centroid is small enough, and further ones, all if need be, until they surely hold k others. Queries meet lists in a shuffle by list, and long lists are split
into parts that every query of the list visits.

Equal vectors are one entry with their k + 1 smallest ids: a query's k nearest can't hold more
of them, as ties go to the smaller id. All rows are indexed.

Bounds: the sample (SAMPLE vectors) and the centroids (MAX_LISTS) are what the driver and each
worker hold, whatever the input.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do those whose length isn't the commonest; rows that repeat an id and a vector count once,
and a query skips every row of its own id; fewer candidates than k give all of them; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.llm.common import cut, stored, table

SAMPLE = 20_000
MAX_LISTS = 4096
PART = 4096


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of a and of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Means of clusters of x, split until each has at most twice its share of the rows."""
    rng, most, done, todo = np.random.default_rng(seed), max(1, 2 * len(x) // max(1, lists)), [], [x]
    while todo:
        own = todo.pop()
        k = min(16, math.ceil(len(own) / most))
        if k < 2:
            done.append(own.mean(axis=0))
            continue
        centres = own[rng.choice(len(own), k, replace=False)]
        for _ in range(6):
            at = squares(own, centres).argmin(axis=1)
            centres = np.stack([own[at == j].mean(axis=0) if (at == j).any() else own[rng.integers(len(own))] for j in range(k)])
        at = squares(own, centres).argmin(axis=1)
        if np.bincount(at).max() == len(own):  # equal rows: halves
            at = np.arange(len(own)) % 2
        todo += [own[at == j] for j in range(k) if (at == j).any()]
    return np.stack(done)


class Graph:
    """A neighbour graph over points, searched by a beam for many queries at once."""

    def __init__(self, points: np.ndarray, degree: int = 24, seed: int = 7):
        n = len(points)
        self.points, degree = points, min(degree, n)
        near = np.concatenate([np.argsort(squares(points[i : i + 512], points), axis=1)[:, :degree] for i in range(0, n, 512)])
        far = np.random.default_rng(seed).integers(n, size=(n, 4))
        self.links = np.hstack([near, far])
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 48)).astype(int))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row of x: the nearest points found, nearest first (-1: none), and their squared distances."""
        d = squares(x, self.points[self.entries])
        order = np.argsort(d, axis=1)[:, :beam]
        ids = np.full((len(x), beam), -1)
        dist, opened = np.full((len(x), beam), np.inf), np.zeros((len(x), beam), bool)
        ids[:, : order.shape[1]] = self.entries[order]
        dist[:, : order.shape[1]] = np.take_along_axis(d, order, axis=1)
        rows = np.arange(len(x))
        while len(rows):
            waiting = np.where(opened[rows], np.inf, dist[rows])
            pick = waiting.argmin(axis=1)
            go = np.isfinite(waiting[np.arange(len(rows)), pick])
            rows, pick = rows[go], pick[go]
            if not len(rows):
                break
            opened[rows, pick] = True
            near = np.sort(self.links[ids[rows, pick]], axis=1)
            known = (near[:, :, None] == ids[rows][:, None, :]).any(axis=2)
            known[:, 1:] |= near[:, 1:] == near[:, :-1]
            gap = self.points[near] - x[rows][:, None, :]
            new = np.where(known, np.inf, np.einsum("ijk,ijk->ij", gap, gap))
            all_ids, all_d = np.hstack([ids[rows], near]), np.hstack([dist[rows], new])
            best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            all_open = np.hstack([opened[rows], np.zeros_like(near, bool)])
            ids[rows], dist[rows] = np.take_along_axis(all_ids, best, axis=1), np.take_along_axis(all_d, best, axis=1)
            opened[rows] = np.take_along_axis(all_open, best, axis=1)
        return np.where(np.isfinite(dist), ids, -1), dist


def _matrix(column) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    sizes = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("v") == (sizes[0] if sizes else 0)).distinct()


def nearest(vectors: DataFrame, is_query, k: int = 20, list_size: int = 128, ratio: float = 1.25, most_lists: int = 48, boundary: float = 1.05, most_copies: int = 4) -> DataFrame:
    """The k nearest found of every vector for which the column is_query holds: query_id, rank, vec_id, score."""
    vectors = stored(usable(vectors), "vectors")
    by_id = W.partitionBy("v").orderBy("vec_id")
    ranked = vectors.withColumn("rn", F.row_number().over(by_id)).where(F.col("rn") <= k + 1)
    items = stored(ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("item"), "v", "ids"), "items")
    n, top = items.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], empty)
    sample = _lifted(np.array([r.v for r in items.select("v").orderBy(F.xxhash64("item"), "item").limit(SAMPLE).collect()], float), top)
    graph = Graph(balanced_centroids(sample, min(MAX_LISTS, max(1, math.ceil(n / list_size)))))
    shared = vectors.sparkSession.sparkContext.broadcast(graph)

    def lists_of(x: np.ndarray, most: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        ids, d = shared.value.search(x, max(16, most))
        ids, d = ids[:, :most], d[:, :most]
        rows, cols = np.nonzero((ids >= 0) & (np.sqrt(d) <= factor * np.sqrt(d[:, :1]) + 1e-12))
        return rows, ids[rows, cols]

    def enough(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As lists_of, and the next nearest lists while those before hold too few entries, each up to most_copies times."""
        rows, lists = lists_of(x, most_lists, ratio)
        held = np.bincount(rows, weights=sizes[lists], minlength=len(x))
        short = np.flatnonzero(held < need)
        if not len(short):
            return rows, lists
        near = np.argsort(squares(x[short], shared.value.points), axis=1, kind="stable")
        own = sizes[near]
        i, j = np.nonzero((own > 0) & (np.cumsum(own, axis=1) - own < need))
        pairs = np.unique(np.stack([np.concatenate([rows, short[i]]), np.concatenate([lists, near[i, j]])], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def post(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                rows, lists = lists_of(_lifted(_matrix(some.column("v")), top), most_copies, boundary)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), *[some.column(c).take(pa.array(rows)) for c in ("item", "v", "ids")]], ["list", "item", "v", "ids"])

    def ask(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                x = _matrix(some.column("v"))
                x = np.hstack([x * (math.sqrt(top) / np.linalg.norm(x, axis=1))[:, None], np.zeros((len(x), 1))]) if len(x) else np.zeros((0, 2))
                rows, lists = enough(x)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), *[some.column(c).take(pa.array(rows)) for c in ("item", "v")]], ["list", "item", "v"])

    postings = stored(items.mapInArrow(post, "list long, item long, v array<double>, ids array<long>"), "postings")
    counts = postings.groupBy("list").count()
    parts = counts.select("list", F.ceil(F.col("count") / PART).cast("long").alias("parts"))
    sizes, need = np.zeros(len(graph.points), np.int64), most_copies * (k + 2)
    for found in counts.collect():  # MAX_LISTS rows at most
        sizes[found["list"]] = found["count"]
    queries = vectors.where(is_query).join(items.select("item", "v"), "v").select(F.col("vec_id").alias("query_id"), "item", "v")
    queries = cut(queries)
    asked = queries.select("item", "v").distinct().mapInArrow(ask, "list long, item long, v array<double>")
    asked = asked.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    postings = postings.join(parts.toDF("list", "own"), "list").withColumn("part", F.pmod(F.xxhash64("item"), F.col("own"))).drop("own")

    def meet(key, own, entries):
        q, x = _matrix(own.column("v").combine_chunks()), _matrix(entries.column("v").combine_chunks())
        if not len(q) or not len(x):
            return pa.table({"item": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        item, q_item = entries.column("item").to_numpy(), own.column("item").to_numpy()
        ids = entries.column("ids").to_pylist()
        out = ([], [], [])
        for i in range(0, len(q), 256):
            rough = q[i : i + 256] @ x.T
            edge = np.partition(rough, -(k + 1), axis=1)[:, -(k + 1)] if len(x) > k + 1 else np.full(len(rough), -np.inf)
            for j, limit in enumerate(edge):
                some = np.flatnonzero(rough[j] >= limit - 1e-9 * max(1.0, abs(limit)) if np.isfinite(limit) else np.ones(len(x), bool))
                score = (x[some] * q[i + j]).sum(axis=1)
                order = np.lexsort((item[some], -score))[: k + 1]
                found = sorted((-s, v) for s, e in zip(score[order].tolist(), some[order].tolist(), strict=True) for v in ids[e])[: k + 1]
                out[0].extend([q_item[i + j]] * len(found))
                out[1].extend(v for _, v in found)
                out[2].extend(-s for s, _ in found)
        return pa.table({"item": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    met = asked.groupBy("list", "part").cogroup(postings.groupBy("list", "part")).applyInArrow(meet, "item long, vec_id long, score double").distinct()
    best = W.partitionBy("item").orderBy(F.desc("score"), "vec_id")
    found = met.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).select("item", "vec_id", "score")
    pairs = queries.select("query_id", "item").join(found, "item").where("query_id <> vec_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]]) if len(x) else np.zeros((0, 2))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
