"""Approximate nearest neighbours with a forest of hash-prefix trees.

A tree is a sorted array of long bit strings, one bit per random hyperplane.  A query descends
in every tree to its longest matching prefix.  Then all trees ascend together, one bit at a
time; the rows that come to share the query's prefix become candidates and are scored.  The
ascent ends for a query when a row as near as its last hit would almost surely have been met:
such a row agrees on a bit with probability 1 - angle/pi, so after depth x it is missed by all
trees with probability (1 - p^x)^trees.  At depth 0 every row is a candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import reachable, stored

BITS = 24


def planes(dims: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng((seed, dims)).standard_normal((dims, trees * BITS)).astype(np.float32)


def strings(vectors: np.ndarray, made: np.ndarray) -> np.ndarray:
    """A row of bit strings, one per tree, the first bit highest."""
    bits = (vectors.astype(np.float32) @ made > 0).reshape(len(vectors), -1, BITS)
    return bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


class Forest:
    """The trees over one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int, seed: int):
        self.ids, self.vectors, self.trees = ids, vectors, trees
        self.planes = planes(vectors.shape[1], trees, seed)
        codes = strings(vectors, self.planes)
        self.order = np.argsort(codes, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(codes.T, self.order, axis=1)
        self.longest = float(np.sqrt((vectors ** 2).sum(1).max()))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, miss: float):
        """Up to k hits of every query: positions in ``ids``, row ids, scores."""
        codes = strings(queries, self.planes)
        norms = np.sqrt((queries ** 2).sum(1))
        low = np.empty((BITS + 1, len(ids), self.trees), np.int32)
        high = np.empty_like(low)
        for tree in range(self.trees):
            for depth in range(BITS + 1):
                shift = BITS - depth
                first = codes[:, tree] >> shift << shift
                low[depth, :, tree] = np.searchsorted(self.sorted[tree], first)
                high[depth, :, tree] = np.searchsorted(self.sorted[tree], first + (1 << shift))
        for q in range(len(ids)):
            seen = np.zeros(len(self.ids), bool)
            seen[self.ids == ids[q]] = True
            hits, scores = np.empty(0, np.int64), np.empty(0)
            for depth in range(BITS, -1, -1):
                size = high[depth, q] - low[depth, q]
                if depth and size.sum() - (0 if depth == BITS else
                                           (high[depth + 1, q] - low[depth + 1, q]).sum()) == 0:
                    continue
                near = np.zeros(len(seen), bool)
                if depth:
                    for tree in np.flatnonzero(size):
                        near[self.order[tree, low[depth, q, tree]:high[depth, q, tree]]] = True
                else:
                    near[:] = True
                new = np.flatnonzero(near & ~seen)
                if not len(new) and depth:
                    continue
                seen[new] = True
                rough = self.vectors[new] @ queries[q]
                if len(hits) >= k:
                    kept = rough >= scores[-1] - 1e-9
                elif len(new) > k:
                    kept = rough >= np.partition(rough, len(rough) - k)[-k] - 1e-9
                else:
                    kept = np.ones(len(new), bool)
                new = new[kept]
                exact = (self.vectors[new] * queries[q]).sum(1)  # equal rows get equal sums
                hits, scores = np.concatenate([hits, new]), np.concatenate([scores, exact])
                best = np.lexsort((self.ids[hits], -scores))[:k]
                hits, scores = hits[best], scores[best]
                if len(hits) == k and depth:
                    cosine = np.clip(scores[-1] / (norms[q] * self.longest), -1, 1)
                    agree = 1 - np.arccos(cosine) / np.pi
                    if (1 - agree ** depth) ** self.trees <= miss:
                        break
            yield q, self.ids[hits], scores


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in packed blocks of about ``size``: ``dims, block, blocks, ids, vectors``."""
    dims = rows.groupBy("dims").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size))
                                    .cast("int").alias("blocks"))
    placed = rows.join(dims, "dims").withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int"))

    def pack(key, table):
        flat = table["vector"].combine_chunks().flatten().to_numpy()
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()),
                         "block": pa.array([key[1].as_py()], pa.int32()),
                         "ids": pa.array([table["vec_id"].to_numpy().tobytes()], pa.binary()),
                         "vectors": pa.array([flat.astype("<f8").tobytes()], pa.binary())})

    return placed.groupBy("dims", "block").applyInArrow(
        pack, "dims int, block int, ids binary, vectors binary")


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vector, dims`` of rows with an id and a vector that is not null, empty or zero
    and holds only finite numbers; a repeated row counts once."""
    v = F.transform(embedding, lambda x: x.cast("double"))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
            .filter(F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
            .filter(F.exists("vector", lambda x: x != 0))
            .dropDuplicates(["vec_id", "vector"])
            .withColumn("dims", F.size("vector")))


def neighbours(vectors: DataFrame, is_query, k: int = 20, *, vec_id: str = "vec_id",
               embedding: str = "embedding", trees: int = 48, miss: float = 0.12,
               rows_a_block: int = 16_384, queries_a_block: int = 2_048,
               seed: int = 3) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for the rows
    that ``is_query`` (a condition on ``vec_id``) picks, among all rows of other ids.

    Rows and queries are packed into blocks of bounded size; every block of rows grows its own
    forest, meets every block of queries and gives its ``k`` nearest, of which the ``k`` best
    remain.  Ties go to the smaller id.  Vectors of another length are not compared.
    """
    spark = vectors.sparkSession
    reachable(spark)
    rows = stored(usable(vectors, vec_id, embedding), "forest-rows")
    index = stored(_blocks(rows, rows_a_block), "forest-index")
    asked = _blocks(rows.filter(is_query), queries_a_block).select(
        "dims", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    pairs = index.select("dims", "block").join(asked, "dims").join(index, ["dims", "block"])

    def search(batches):
        held, forest = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
                dims, ids = get("dims"), np.frombuffer(get("ids"), np.int64)
                name = (dims, get("block"))
                if held != name:
                    forest = Forest(ids, np.frombuffer(get("vectors"), "<f8").reshape(-1, dims),
                                    trees, seed)
                    held = name
                q_ids = np.frombuffer(get("q_ids"), np.int64)
                asks = np.frombuffer(get("q_vectors"), "<f8").reshape(-1, dims)
                out = [(np.full(len(h), q_ids[q]), h, s)
                       for q, h, s in forest.search(q_ids, asks, k, miss)]
                if out:
                    a, b, c = (np.concatenate(x) for x in zip(*out))
                    yield pa.record_batch({"query_id": a, "vec_id": b, "score": c})

    found = (pairs.repartition("dims", "block").sortWithinPartitions("dims", "block")
             .mapInArrow(search, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"])
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
