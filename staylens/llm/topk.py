"""Exact top-k by inner product, aggregating sorted lists without random access.

Every component of the candidates is a list sorted by value.  For a query, a list is read from
its top where the query's component is positive and from its bottom where it is negative, so
contributions only fall.  A candidate's lower score bound is what was seen of it plus the least
that the other lists can give, its upper bound has the next unread contribution of those lists
instead.  An outsider, seen in no list yet, has the sum of all next contributions as its upper
bound.  Reading stops as soon as no outsider can reach the k-th best lower bound, or none is
left; then the final scores of the candidates whose upper bound reaches it are resolved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import staged

#: Candidates whose lists one task holds at a time, and queries that read them there.
CANDIDATES = 8192
QUERIES = 1024
#: Parts in which a list is read; outsiders are looked at after each.
ROUNDS = 16
#: Above this share of candidates to resolve, the block is multiplied as it lies.
GATHER = 0.2


class Lists:
    """The sorted lists of a block of candidates: per component, rows and values by falling value.

    Values are whole numbers held as doubles, so sums are exact up to 2**53.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order], dtype=np.float64)
        self.rows = np.argsort(-self.vectors.T, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.vectors.T, self.rows, axis=1)
        #: what a place of a list is worth above its last place, read from the top or the bottom
        self.above = (self.values - self.values[:, -1:], self.values - self.values[:, :1])

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best but ``own``, best first, ties to the smaller id."""
        n = len(self.ids)
        query = query.astype(np.float64)
        skipped = slice(np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, side="right"))
        # Lists of positive components are read from the top, of negative ones from the bottom.
        sides = [(np.flatnonzero(query > 0), 0), (np.flatnonzero(query < 0), 1)]
        worst = sum(float(self.values[c, side - 1] @ query[c]) for c, side in sides)
        seen, outside = np.zeros(n), np.ones(n, dtype=bool)
        step = -(-n // ROUNDS)
        for at in range(0, n, step):
            end = min(at + step, n)
            for c, side in sides:
                part = slice(n - end, n - at) if side else slice(at, end)
                rows = self.rows[c, part].ravel()
                gain = self.above[side][c, part]
                gain *= query[c][:, None]
                seen += np.bincount(rows, weights=gain.ravel(), minlength=n)
                outside[rows] = False
            outside[skipped] = False
            lower = seen + worst
            lower[skipped] = -np.inf
            if end == n:
                break
            kth = np.partition(lower, n - k)[n - k] if n > k else -np.inf
            # What a list has next above its worst, and so gives at most to rows not seen in it.
            following = [self.above[side][c, n - end - 1 if side else end] * query[c] for c, side in sides]
            if outside.any() and worst + sum(float(f.sum()) for f in following) >= kth:
                continue
            upper = lower + sum(float(f.sum()) for f in following)
            for (c, side), most in zip(sides, following, strict=True):
                rows = self.rows[c, slice(n - end, n) if side else slice(0, end)]
                upper -= np.bincount(rows.ravel(), weights=np.repeat(most, rows.shape[1]), minlength=n)
            may = np.flatnonzero((upper >= kth) & (upper > -np.inf))
            few = len(may) < GATHER * n
            scores = self.vectors[may] @ query if few else (self.vectors @ query)[may]
            return self._best(may, scores, k)
        rest = np.flatnonzero(lower > -np.inf)
        return self._best(rest, lower[rest], k)

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) > 4 * k:  # all ties with the k-th best stay
            least = np.partition(scores, len(rows) - k)[len(rows) - k]
            rows, scores = rows[scores >= least], scores[scores >= least]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], np.rint(scores[order]).astype(np.int64)


def quantised(vectors: DataFrame, is_query: Column, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, size, vector, is_query)`` of whole numbers, without the rows that take no part."""
    numbers = F.col(vector_col).cast("array<double>")
    odd = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.size(vector_col).alias("size"),
        F.transform(numbers, lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` others for every row that ``is_query`` selects.

    Scores are inner products of ``floor(scale * x)``; ties go to the smaller id.  Vectors that
    are null or hold nulls or numbers that are not finite take no part, nor do rows without an
    id.  Vectors of different length are not compared.  A repeated row is a candidate as often as
    it occurs, never for its own id; of several query rows with one id the smallest vector asks.

    Candidates and queries are cut into blocks by a hash.  A task holds the lists of one block of
    candidates and reads them for one block of queries; at most ``k`` rows a query leave it.
    """
    rows = staged(quantised(vectors, is_query, scale, id_col, vector_col), "topk_vectors")
    asked = rows.filter("is_query").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = staged(asked.withColumn("size", F.size("vector")), "topk_queries")
    blocks, query_blocks = -(-rows.count() // candidates) or 1, -(-asked.count() // queries) or 1
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block")
    query_block = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("query_block")
    keys = ["size", "block", "query_block"]
    left = rows.select("size", block, every(query_blocks, "query_block"), "vec_id", "vector").groupBy(*keys)
    right = asked.select("size", every(blocks, "block"), query_block, "vec_id", "vector").groupBy(*keys)

    def read(key: tuple, block: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if block.num_rows and asking.num_rows:
            lists = Lists(block["vec_id"].to_numpy(), _matrix(block["vector"], key[0].as_py()))
            for own, query in zip(asking["vec_id"].to_pylist(), _matrix(asking["vector"], key[0].as_py()), strict=True):
                ids, scores = lists.top(own, query, k)
                found.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate([f[i] for f in found] or [np.zeros(0)]).astype(np.int64) for i in range(3)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    best = left.cogroup(right).applyInArrow(read, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(len(column), size)
