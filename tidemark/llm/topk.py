"""Exact top-k by inner product with the threshold algorithm.

Vectors lie in blocks.  In a block every dimension has its list of vectors sorted by
that component.  A query walks all lists together, from the end that helps it; vectors
met for the first time are scored in full.  No vector still unmet can score more than
the sum of the products at the lists' present places, so the walk ends when the kth
score found beats that bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sources.scratch import cut_lineage

_HIT = "query_id long, number long, vec_id long, score long"


def integer_vector(vector: str, factor: int = 256) -> Column:
    """floor(factor * x) of each component as long; null if any component is null or not finite."""
    x = F.col(vector)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(factor))).cast("long"))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return F.when(usable, whole)


class Block:
    """Vectors of a block and their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.floats = vectors.astype(float)
        self.largest = int(np.abs(vectors).max(initial=0))
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer products; by floats, which are faster, where every sum stays exact."""
        if self.largest * int(np.abs(query).max(initial=0)) * len(query) < 1 << 53:
            return (self.floats[rows] @ query.astype(float)).astype(np.int64)
        return self.vectors[rows] @ query

    def search(self, query: np.ndarray, own: int | None, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, ties to the smaller id; each step goes twice as deep."""
        n, dims = self.vectors.shape
        down = query > 0
        used = np.flatnonzero(query)
        met = np.zeros(n, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        while True:
            to = min(depth + step, n)
            places = np.arange(depth, to)
            if len(used):
                at = np.where(down[used], n - 1 - places[:, None], places[:, None])
                seen = self.order[at, used]
                fresh = np.zeros(n, bool)
                fresh[seen.ravel()] = True
                new = np.flatnonzero(fresh & ~met)
            else:
                new = places
            met[new] = True
            if own is not None:
                new = new[self.ids[new] != own]
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, self._scores(new, query)])
            best = np.lexsort((self.ids[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
            if to == n or met.all():
                return rows, scores
            depth, step = to, 2 * step
            # An unmet vector may equal the bound and have a smaller id: only a higher kth score ends the walk.
            if len(used):
                bound = int((self.sorted[np.where(down[used], n - depth, depth - 1), used] * query[used]).sum())
                if len(rows) == k and scores[-1] > bound:
                    return rows, scores


def _search_blocks(k: int, step: int):
    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "number", "vec_id", "score")})

        def matrix(t: pa.Table) -> np.ndarray:
            flat = t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.astype(np.int64).reshape(t.num_rows, -1)

        block = Block(vectors.column("vec_id").to_numpy(), matrix(vectors))
        out: list[tuple[np.ndarray, ...]] = []
        for own, number, query in zip(queries.column("vec_id").to_pylist(), queries.column("number").to_pylist(), matrix(queries), strict=True):
            rows, scores = block.search(query, own, k, step)
            out.append((np.full(len(rows), own), np.full(len(rows), number), block.ids[rows], scores))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "number", "vec_id", "score"), columns, strict=True)))

    return run


def _each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192, query_rows: int = 1024, step: int = 32) -> DataFrame:
    """The k highest inner products of each query: query_id, rank (from 1), vec_id, score.

    Both frames have `vec_id` and `vector` (array<long>); rows with a null vector or id
    take no part, other columns are ignored.  Repeated query rows are one query; different
    vectors under one id are queries of their own, each with its ranks.  Rows of a query's
    id are not its candidates; ties go to the smaller id; with fewer than k candidates all are returned.  Only vectors of
    the query's length are candidates.  Equal rows of one id count as separate
    candidates.  Scores must fit 64 bits.  Every block of queries meets every block of
    vectors; a task holds one of each.
    """
    usable = F.col("vector").isNotNull() & F.col("vec_id").isNotNull()
    vectors, queries = (t.select("vec_id", "vector").where(usable).withColumn("dims", F.size("vector")) for t in (vectors, queries))
    # Written, so that the numbers of the queries are the same wherever they are read.
    queries = cut_lineage(queries.distinct().withColumn("number", F.monotonically_increasing_id()), "queries")
    vector_blocks = max(1, -(-vectors.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))
    placed = vectors.select("dims", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(vector_blocks)).alias("vb"), _each(query_blocks).alias("qb"), "vec_id", "vector")
    asked = queries.select("dims", _each(vector_blocks).alias("vb"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).alias("qb"), "vec_id", "number", "vector")
    keys = ["dims", "vb", "qb"]
    hits = asked.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(_search_blocks(k, step), _HIT)
    rank = F.row_number().over(W.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_query(embeddings: DataFrame) -> DataFrame:
    vectors = embeddings.select("vec_id", integer_vector("embedding").alias("vector"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))
