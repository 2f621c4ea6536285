"""Approximate nearest neighbours by vantage-point trees.

Vectors are dealt to cells, each around the nearest of the centers (vectors drawn by hash; this is the only sample; their
number grows with the root of the rows, so that cells and centers stay in balance), and a cell to shards of about ``SHARD_ROWS`` vectors. Every row is in a shard. A shard builds its vantage-point tree and
searches it for the queries sent to it. A query first visits the cell it lies in; the distance of its k-th neighbour
there prunes cells by the triangle inequality, and the rest is visited in a second pass.

Both cells and subtrees are pruned where ``factor`` times the lower bound of the distance exceeds the distance of the k-th
neighbour so far: factor 1 is exact search, larger factors prune more.

Equal vectors are one entry with its ``k + 1`` smallest ids, since no other copy can be among k neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkfolio.llm.spark_env import prepare, stored

#: Fewest rows of a cell on average, and centers for each root of the number of vectors.
CELL_ROWS = 1000
CENTERS = 0.5
SHARD_ROWS = 8192
LEAF = 32
FACTOR = 1.5


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from differences."""
    out = np.empty((len(queries), len(points)))
    step = min(64, max(1, (1 << 22) // max(1, points.size)))
    for at in range(0, len(queries), step):
        out[at:at + step] = np.sqrt(((queries[at:at + step, None] - points[None]) ** 2).sum(-1))
    return out


def n_centers(n: int) -> int:
    """Centers for ``n`` vectors."""
    return max(1, min(n // CELL_ROWS, math.ceil(CENTERS * math.sqrt(n))))


class VPTree:
    """Vantage-point tree over ``points``; equal distances are ordered by ``ids``."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, seed: int = 0):
        self.points, self.ids = points, ids
        rng = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][3][side] = me
            if len(rows) <= LEAF:
                self.nodes.append((rows, None, 0.0, [-1, -1]))
                continue
            top = int(rng.integers(len(rows)))
            rest = np.delete(rows, top)
            far = distances(points[rows[top]][None], points[rest])[0]
            order = np.argsort(far, kind="stable")
            half = len(order) // 2
            self.nodes.append((rows[top:top + 1], far[order[half - 1]], far[order[half]], [-1, -1]))
            todo += [(rest[order[half:]], me, 1), (rest[order[:half]], me, 0)]

    def search(self, queries: np.ndarray, k: int, factor: float, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, row) of the k nearest for each query, nearest first; ``bound``: a distance known to suffice.
        Missing neighbours have distance infinity and row -1."""
        best = np.full((len(queries), k), np.inf)
        row = np.full((len(queries), k), -1)
        if not len(self.points):
            return best, row
        ids = np.append(self.ids, np.iinfo(np.int64).max)

        def reach(q: np.ndarray) -> np.ndarray:
            return np.minimum(best[q, -1], bound[q]) * (1 + 1e-9)

        def take(q: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
            d = np.hstack((best[q], far))
            r = np.hstack((row[q], np.broadcast_to(rows, far.shape)))
            order = np.lexsort((ids[r], d), axis=-1)[:, :k]
            best[q], row[q] = np.take_along_axis(d, order, 1), np.take_along_axis(r, order, 1)

        todo = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while todo:
            node, q, low = todo.pop()
            q = q[low * factor <= reach(q)]
            if not len(q):
                continue
            rows, inner, outer, (left, right) = self.nodes[node]
            far = distances(queries[q], self.points[rows])
            take(q, rows, far)
            if inner is not None:
                far = far[:, 0]
                near = far <= inner
                to_left, to_right = np.maximum(far - inner, 0), np.maximum(outer - far, 0)
                for mask, first, second in ((near, (left, to_left), (right, to_right)), (~near, (right, to_right), (left, to_left))):
                    if mask.any():                           # what is pushed last is visited first
                        todo += [(second[0], q[mask], second[1][mask]), (first[0], q[mask], first[1][mask])]
        return best, row


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def _search(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    names = ["query_id", "ids", "score"]
    if not len(vectors) or not len(queries):
        return pd.DataFrame(columns=names, dtype=object)
    vectors = vectors.sort_values("least")
    tree = VPTree(_matrix(vectors["embedding"]), vectors["least"].to_numpy())
    best, row = tree.search(_matrix(queries["embedding"]), k + 1, factor, queries["reach"].to_numpy(np.float64))
    q, i = np.nonzero(row >= 0)
    ids = vectors["ids"].to_numpy()
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[q], "ids": ids[row[q, i]], "score": best[q, i]})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that take part: not null, not zero, all components finite."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of (query_id, ids, score), one row for each id but the query's own."""
    each = rows.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of ``vectors`` (vec_id long, embedding array) found for every row of
    ``queries`` (the same columns), nearest first, ties to the smaller vec_id; other columns are ignored.

    A query's own id is no neighbour. Rows with a null id or vector, the zero vector and vectors with null or non-finite components take
    no part; vectors of another length than the query's are none of its neighbours. Rows that repeat count each time; fewer than k
    candidates give fewer rows; empty tables give none. ``factor`` 1 finds exactly the nearest.
    """
    spark = prepare(vectors.sparkSession)
    all_rows = usable(vectors)
    order = Window.partitionBy("embedding").orderBy("vec_id")
    classes = stored(all_rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).groupBy("embedding").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("least", F.element_at("ids", 1)), "vectors")
    n = classes.count()
    centers = [np.array(r.embedding) for r in classes.orderBy(F.xxhash64("least"), "least").limit(n_centers(n)).collect()]

    def to_centers(column: pd.Series) -> np.ndarray:
        """Distances to the centers of the same length (infinite to others; the first center if there is none)."""
        out = np.full((len(column), len(centers)), np.inf)
        size = column.map(len).to_numpy()
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            cols = [i for i, c in enumerate(centers) if len(c) == length]
            if cols:
                out[np.ix_(rows, cols)] = distances(_matrix(column.iloc[rows]), np.array([centers[i] for i in cols]))
        return out

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            far = to_centers(b["embedding"])
            cell = far.argmin(1)
            yield b.assign(cell=cell, far=far[np.arange(len(b)), cell], dim=b["embedding"].map(len))

    dealt = classes.mapInPandas(deal, "embedding array<double>, ids array<long>, least long, cell int, far double, dim int")
    stats = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    stats = stats.withColumn("parts", F.ceil(F.col("n") / SHARD_ROWS).cast("int"))
    cells = stored(stats, "cells")
    shards = dealt.join(cells.select("dim", "cell", "parts"), ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("least"), F.col("parts")).cast("int")).select("dim", "cell", "part", "embedding", "ids", "least")
    shards = stored(shards, "shards")
    asked = stored(usable(queries).select(F.col("vec_id").alias("query_id"), "embedding").distinct(), "queries")
    small = cells.groupBy("cell").agg(F.max("radius").alias("radius")).collect()          # a row for each center
    radius = np.full(max(1, len(centers)), -np.inf)
    for r in small:
        radius[r.cell] = r.radius

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """First pass: the query's own cell. Second pass (``reach`` given): all other cells that may hold a neighbour."""
        for b in batches:
            far = to_centers(b["embedding"])
            own = far.argmin(1)
            near = far[np.arange(len(b)), own]
            if "reach" not in b:
                yield b.assign(cell=own, dim=b["embedding"].map(len), reach=np.inf)
                continue
            with np.errstate(invalid="ignore"):
                low = np.maximum(far - radius, (far - near[:, None]) / 2)    # ball, and half-space of the nearer center
                low = np.where(np.isfinite(far), np.maximum(low, 0), np.where(np.isfinite(near)[:, None], np.inf, 0))
            visit = low * factor <= b["reach"].to_numpy()[:, None] * (1 + 1e-9)
            visit[np.arange(len(b)), own] = False
            q, c = np.nonzero(visit)
            yield b.iloc[q].assign(cell=c, dim=b["embedding"].map(len).to_numpy()[q])[
                ["query_id", "embedding", "cell", "dim", "reach"]]

    def visit(sent: DataFrame) -> DataFrame:
        sent = sent.join(cells.select("dim", "cell", "parts"), ["dim", "cell"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        keys = ["dim", "cell", "part"]
        return shards.groupBy(*keys).cogroup(sent.select(*keys, "query_id", "embedding", "reach").groupBy(*keys)).applyInPandas(
            lambda key, v, q: _search(key, v, q, k, factor), "query_id long, ids array<long>, score double")

    sent = "query_id long, embedding array<double>, cell int, dim int, reach double"
    first = stored(visit(asked.mapInPandas(route, sent)), "first")
    reach = _top(first, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("reach")).filter(
        F.col("n") == k).select("query_id", "reach")
    again = asked.join(reach, "query_id", "left").select(
        "query_id", "embedding", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    second = visit(again.mapInPandas(route, sent))
    return _top(first.unionByName(second), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
