"""Exact top-k by inner product with two cover trees.

Candidates are dealt into blocks of bounded size and meet the queries block by block. Within a pair of blocks both
sides are indexed by a cover tree: every node has one of its points as centre, its children's centres are a cover of
its points at a radius smaller by a constant factor, and it keeps the largest distance to a point below it. A pair of
nodes is left out when even the best inner product their radii allow is below the worst k-th score of the queries in
the group. Scores are integers, so nothing is lost to rounding; ties stay in and go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, SCALE = 20, 64
LEAF, FAN, BASE = 512, 32, 1.3  # points of a leaf, children of a node, ratio of a level's radius to the next
QUERIES, CANDIDATES, SAMPLE = 4096, 16384, 8192  # rows of a block; candidates that give the first bound
EXACT = float(1 << 53)


@dataclass
class Node:
    centre: np.ndarray
    length: float
    radius: float
    points: np.ndarray
    children: list["Node"] = field(default_factory=list)


def cover_tree(x: np.ndarray, points: np.ndarray, centre: int) -> Node:
    """Tree over rows ``points`` of ``x``. Centres of the next level are picked farthest first until all points are covered at
    the next radius, or there are FAN of them; each child keeps the radius it really has."""
    distance = np.sqrt(((x[points] - x[centre]) ** 2).sum(axis=1))
    node = Node(x[centre], float(np.sqrt((x[centre] ** 2).sum())), float(distance.max(initial=0.0)), points)
    if len(points) <= LEAF or node.radius == 0:
        return node
    goal, centres, owner = node.radius / BASE, [centre], np.zeros(len(points), dtype=np.int64)
    while distance.max() > goal and len(centres) < FAN:
        far = int(distance.argmax())
        own = np.sqrt(((x[points] - x[points[far]]) ** 2).sum(axis=1))
        nearer = own < distance
        owner[nearer] = len(centres)
        distance[nearer] = own[nearer]
        centres.append(int(points[far]))
    if len(centres) > 1:
        for i, c in enumerate(centres):
            below = points[owner == i]
            if len(below):
                node.children.append(cover_tree(x, below, c))
    return node


class Best:
    """The k best (score, id) of every query so far, and a lower bound on the k-th score from elsewhere."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.astype(float)
        self.scores, self.ids = [np.empty(0)] * n, [np.empty(0, dtype=np.int64)] * n

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        if len(scores) > 4 * self.k:
            enough = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[enough], ids[enough]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.kth[q] = max(self.kth[q], scores[order[-1]])


def dual_search(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, floor: np.ndarray) -> tuple:
    """(query row, id, score) of the k best candidates of each query that are not below its ``floor``."""
    best = Best(len(q), k, floor)
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < EXACT
    slack = 1e-9 * (1 + float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1])
    wide_q, wide_c = (None, None) if exact else ([[int(v) for v in r] for r in q], [[int(v) for v in r] for r in c])

    norms = np.sqrt((q**2).sum(axis=1))

    def scores(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        if exact:
            return q[rows] @ c[points].T
        return np.array([[float(sum(a * b for a, b in zip(wide_q[i], wide_c[j], strict=True))) for j in points] for i in rows])

    def bound(a: Node, b: Node) -> float:
        return float(a.centre @ b.centre) + a.radius * b.length + b.radius * a.length + a.radius * b.radius + slack

    stack = [(cover_tree(q, np.arange(len(q)), 0), cover_tree(c, np.arange(len(c)), 0))]
    while stack:
        a, b = stack.pop()
        if bound(a, b) < best.kth[a.points].min():
            continue
        if not a.children and not b.children:
            # of the group, the queries whose own bound reaches into the node
            rows = a.points[q[a.points] @ b.centre + b.radius * norms[a.points] + slack >= best.kth[a.points]]
            if not len(rows):
                continue
            found, ids = scores(rows, b.points), c_ids[b.points]
            good = (found >= best.kth[rows][:, None]) & (ids[None, :] != q_ids[rows][:, None])
            for i in np.flatnonzero(good.any(axis=1)).tolist():
                best.offer(int(rows[i]), found[i, good[i]], ids[good[i]])
        else:
            pairs = [(x, b) for x in a.children] if a.children and (a.radius >= b.radius or not b.children) else [(a, y) for y in b.children]
            stack += sorted(pairs, key=lambda p: bound(*p))  # the most promising pair is taken next
    rows = np.repeat(np.arange(len(q)), [len(i) for i in best.ids])
    return rows, np.concatenate([*best.ids, np.empty(0, np.int64)]), np.concatenate([*best.scores, np.empty(0)])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), -1)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def top_k(vectors: DataFrame, chosen: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each row of ``vectors`` where ``chosen`` holds.

    Vectors that are null or empty or hold a null or non-finite component, and rows without an id, take no part; vectors
    of different lengths are not compared. Rows that share an id with the query count as its own; a query id that
    occurs more than once is asked with its smallest vector. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v"), chosen.alias("asked"))
    rows = rows.withColumn("size", F.size("v"))
    asked = rows.where("asked").groupBy("vec_id", "size").agg(F.min("v").alias("v"))
    n, m = rows.count(), asked.count()
    columns = "query_id long, rank int, vec_id long, score long"
    if not m:
        return spark.createDataFrame([], columns)
    blocks, groups = -(-n // CANDIDATES), -(-m // QUERIES)

    # a first bound for every query: its k-th score among a bounded sample
    draw = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = [(r.vec_id, r.v) for r in rows.where(draw < 2 * SAMPLE / n).select("vec_id", "v").limit(SAMPLE).collect()]

    def first_bound(batches):
        by_size: dict[int, list] = {}
        for i, v in sample:
            by_size.setdefault(len(v), []).append((i, v))
        for batch in batches:
            floor = np.full(len(batch), -np.inf)
            for size, own in by_size.items():
                at = np.flatnonzero(batch["size"].to_numpy() == size)
                ids, c = np.array([i for i, _ in own]), np.array([v for _, v in own])
                q = _matrix(batch["v"].iloc[at])
                if len(at) and len(own) > k and float(np.abs(q).max()) * float(np.abs(c).max()) * size < EXACT:
                    found = q @ c.T
                    found[batch["vec_id"].to_numpy()[at][:, None] == ids[None, :]] = -np.inf
                    floor[at] = np.partition(found, len(own) - k, axis=1)[:, len(own) - k]
            yield batch.assign(floor=floor)

    queries = asked.mapInPandas(first_bound, "vec_id long, size int, v array<double>, floor double")
    home = lambda salt, parts: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = queries.withColumn("g", home(1, groups)).withColumn("b", every(blocks))
    right = rows.select("vec_id", "size", "v", F.pmod(F.xxhash64("vec_id", "v", F.lit(2)), F.lit(blocks)).cast("int").alias("b")).withColumn("g", every(groups))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        a = a.sort_values("vec_id", kind="stable")
        ids = a["vec_id"].to_numpy()
        row, found, score = dual_search(_matrix(a["v"]), ids, _matrix(b["v"]), b["vec_id"].to_numpy(), k, a["floor"].to_numpy())
        return pd.DataFrame({"query_id": ids[row], "vec_id": found, "score": np.clip(score, -9.2e18, 9.2e18).astype(np.int64)})

    pairs = left.groupBy("g", "b", "size").cogroup(right.groupBy("g", "b", "size")).applyInPandas(search, "query_id long, vec_id long, score long")
    # k rows per query and block at most: their order is settled in the row
    best = pairs.groupBy("query_id").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("all"))
    ranked = best.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
