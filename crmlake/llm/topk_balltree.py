"""Exact top-k by integer inner product: ball trees per shard, branch and bound, shared bounds.

Candidates are dealt into shards of about ``SHARD`` vectors, and each shard builds one ball tree. A
ball with centre c and radius r holds no vector whose product with q exceeds q.c + |q| r. While a
shard's tree is built, the queries that live in the shard are searched in it; the k-th score found is
a lower bound of the query's final k-th score and is shared with all other shards. There a node is
entered only while its bound reaches the bound shared or found since, leaves in order of their bound.

Queries meet shards as a grid of blocks (query block x shard), so a task holds one shard and one block
of queries; no block depends on the size of the input.

Defined cases: vectors that are null, empty or of another length than most, or hold null or non-finite
numbers take no part; zero vectors do; ties go to the smaller id; rows that repeat an id count once;
fewer than k candidates are all returned; an empty table gives no rows. Numbers are floor(256 x);
products are exact while they are below 2^53, for which all |x| below 4 * 10^4 is enough at 64 numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.vectors import blocks_of, ids, matrix, packed, ranked

SHARD = 8192
QUERY_BLOCK = 1024
LEAF = 128


class BallTree:
    """Vectors in leaf order; node j has children 2j + 1 and 2j + 2, leaves are the last level."""

    def __init__(self, vectors: np.ndarray, vec_ids: np.ndarray):
        n = len(vectors)
        self.depth = max(0, math.ceil(math.log2(max(1, n / LEAF))))
        order = np.arange(n)
        bounds = [(0, n)]
        self.centres, self.radii = [], []
        for level in range(self.depth + 1):
            children = []
            for a, b in bounds:
                part = vectors[order[a:b]]
                centre = part.mean(0) if b > a else np.zeros(vectors.shape[1])
                distance = np.sqrt(((part - centre) ** 2).sum(1)) if b > a else np.zeros(1)
                self.centres.append(centre)
                self.radii.append(distance.max() * (1 + 1e-12) + 1e-9)
                if level < self.depth:
                    middle = (a + b) // 2
                    if b - a > 1:
                        pole = part[distance.argmax()]
                        other = part[((part - pole) ** 2).sum(1).argmax()]
                        along = part @ (other - pole)
                        order[a:b] = order[a:b][np.argpartition(along, middle - a)]
                    children += [(a, middle), (middle, b)]
            if level < self.depth:
                bounds = children
        self.vectors, self.ids, self.leaves = vectors[order], vec_ids[order], bounds
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def to_bytes(self) -> bytes:
        import pickle

        return pickle.dumps((self.depth, self.leaves, self.vectors.astype(np.float32)
                             if np.abs(self.vectors).max(initial=0) < 1 << 24 else self.vectors,
                             self.ids, self.centres, self.radii), 5)

    @classmethod
    def from_bytes(cls, data: bytes) -> "BallTree":
        import pickle

        tree = cls.__new__(cls)
        tree.depth, tree.leaves, vectors, tree.ids, tree.centres, tree.radii = pickle.loads(data)
        tree.vectors = vectors.astype(float)
        return tree

    def leaf_bounds(self, queries: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Upper bound of each query's product in each leaf; -inf below a node that cannot reach ``least``."""
        length = np.sqrt((queries ** 2).sum(1))
        bound = np.full((len(queries), 1), np.inf)
        first = 0
        for level in range(self.depth + 1):
            nodes = slice(first, first + (1 << level))
            own = queries @ self.centres[nodes].T + length[:, None] * self.radii[nodes] + 1e-6
            bound = np.minimum(bound, own)
            bound[bound < least[:, None]] = -np.inf
            first += 1 << level
            if level < self.depth:
                bound = np.repeat(bound, 2, 1)
        return bound

    def search(self, queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, k: int):
        """Ids and scores [query, k] of the best, -inf where fewer reach ``least``."""
        best = np.full((len(queries), k), -np.inf)
        of = np.full((len(queries), k), np.iinfo(np.int64).max)
        bounds = self.leaf_bounds(queries, least)
        order = np.argsort(-bounds, 1, kind="stable")
        floor = least.copy()
        for step in range(len(self.leaves)):
            leaf = order[:, step]
            bound = bounds[np.arange(len(queries)), leaf]
            active = np.flatnonzero((bound >= floor) & (bound > -np.inf))
            if not len(active):
                break
            for at in np.unique(leaf[active]):
                a, b = self.leaves[at]
                who = active[leaf[active] == at]
                score = queries[who] @ self.vectors[a:b].T
                score[query_ids[who][:, None] == self.ids[a:b]] = -np.inf
                score[score < floor[who][:, None]] = -np.inf
                some = np.flatnonzero((score > -np.inf).any(1))
                if not len(some):
                    continue
                who, score = who[some], score[some]
                scores = np.concatenate([best[who], score], 1)
                names = np.concatenate([of[who], np.broadcast_to(self.ids[a:b], score.shape)], 1)
                by = np.lexsort((names, -scores), axis=1)[:, :k]
                best[who], of[who] = np.take_along_axis(scores, by, 1), np.take_along_axis(names, by, 1)
                floor[who] = np.maximum(floor[who], best[who, k - 1])
        return of, best


def _rows(query_ids: np.ndarray, of: np.ndarray, best: np.ndarray) -> pa.Table:
    q, r = np.nonzero(best > -np.inf)
    return pa.table({"query_id": query_ids[q], "vec_id": of[q, r], "score": best[q, r].astype(np.int64)})


def search(table: DataFrame, queries: "F.Column", k: int, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best of each row for which ``queries`` (of vec_id) holds."""
    rows = packed(table, id_column, vector_column, zero=True,
                  transform=lambda c: F.floor(256 * c).cast("double")).checkpoint()
    n = rows.count()
    shards = max(1, -(-n // SHARD))
    asked = rows.where(queries).select("vec_id", F.lit(True).alias("asked"))
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    rows = rows.withColumn("asked", queries).withColumn("shard", blocks_of("vec_id", shards, 1))

    def build(key, group):
        """The shard's tree, and the k-th score in it of each query that lives there."""
        vec_ids, v = ids(group["vec_id"]), matrix(group["v"])
        tree = BallTree(v, vec_ids)
        at = np.flatnonzero(group["asked"].to_numpy())
        _, best = tree.search(v[at], vec_ids[at], np.full(len(at), -np.inf), k)
        shard, none = key[0].as_py(), [None] * len(at)
        return pa.table([pa.array([shard] * (1 + len(at)), pa.int32()), pa.array([tree.to_bytes(), *none], pa.binary()),
                         pa.array([None, *vec_ids[at].tolist()], pa.int64()),
                         pa.array([None, *(v[i].tobytes() for i in at)], pa.binary()),
                         pa.array([None, *best[:, k - 1].tolist()], pa.float64())],
                        names=["shard", "tree", "query_id", "v", "least"])

    built = rows.groupBy("shard").applyInArrow(
        build, "shard int, tree binary, query_id long, v binary, least double").checkpoint()
    trees = (built.where("tree IS NOT NULL").select("shard", "tree")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    asking = (built.where("query_id IS NOT NULL").select("query_id", "v", "least")
              .withColumn("block", blocks_of("query_id", n_blocks, 2))
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def meet(left, right):
        if not left.num_rows or not right.num_rows:
            return _rows(np.zeros(0, np.int64), np.zeros((0, k), np.int64), np.zeros((0, k)))
        tree, query_ids = BallTree.from_bytes(left["tree"][0].as_py()), ids(right["query_id"])
        return _rows(query_ids, *tree.search(matrix(right["v"]), query_ids, ids(right["least"]), k))

    found = trees.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInArrow(
        meet, "query_id long, vec_id long, score long")
    return (ranked(found, [F.desc("score"), F.col("vec_id")], k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
