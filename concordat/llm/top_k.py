"""Exact top-k search by inner product with Fagin's threshold algorithm.

Every block of rows is kept as one sorted list for each dimension. A query reads the lists of its non-zero components from
the end that its sign favours, some entries at a time, and computes the whole product of each row the first time that it
is met. No row that was not met can score above the sum of the query's components times the values where the lists were
left; once that is below the k-th score so far, the search of the block is over. The k best of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.shared import stored
from concordat.llm.vectors import Block, first_of, in_tiles, longs, whole_vectors

#: Entries read from each list before the first look at the bound; every further step reads twice as many.
FIRST_STEP = 16


class SortedLists:
    """One list for each dimension: places of the block's rows by rising value."""

    def __init__(self, block: Block):
        self.ids, self.x = block.ids, block.x
        self.order = np.argsort(block.x, axis=0, kind="stable").astype(np.int32).T.copy()

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(places, scores, rows met) of the k best rows with another id than own, best first, ties to smaller ids."""
        count = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        met = np.zeros(count, bool)
        best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, max(FIRST_STEP, k)
        while depth < count:
            end = min(count, depth + step)
            new = np.zeros(count, bool)
            if len(up) + len(down):
                new[self.order[up, count - end : count - depth].ravel()] = True
                new[self.order[down, depth:end].ravel()] = True
                new &= ~met
            else:
                new[:], end = True, count  # all scores are 0
            met |= new
            fresh = np.flatnonzero(new)
            fresh = fresh[self.ids[fresh] != own]
            best, scores = np.concatenate([best, fresh]), np.concatenate([scores, longs(self.x[fresh] @ q)])
            at = first_of(scores, self.ids[best], k)
            best, scores = best[at], scores[at]
            depth, step = end, step * 2
            if depth < count and len(best) == k:
                edge = (self.x[self.order[up, count - depth], up] * q[up]).sum() + (self.x[self.order[down, depth - 1], down] * q[down]).sum()
                if longs(np.array([edge]))[0] < scores[-1]:  # an equal score could still win by its id
                    break
        return best, scores, int(met.sum())


def exact_top_k(
    vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k highest scores of every query: query_id, rank from 1, vec_id, score; fewer where there are fewer rows.

    queries says which rows ask; all rows with another id answer. The score is the inner product of the vectors with each
    component x replaced by floor(scale * x); ties go to smaller ids. Rows with a null id, a null vector or a component
    that is null or not finite take no part. Equal rows each answer, but ask once; rows that share an id with different
    vectors ask each, and none answers another. A shorter vector counts as 0 in what it lacks. Scores beyond 64 bits are
    held at their ends. An empty table, and one without queries, gives no rows.
    """
    rows, shape = whole_vectors(vectors, scale, id_col, vector_col)
    asked = whole_vectors(vectors.where(queries), scale, id_col, vector_col)[0].distinct()
    asked = stored(asked.withColumn("key", F.monotonically_increasing_id()), "queries")

    def start(block: Block):
        lists = SortedLists(block)

        def ask(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
            own, keys = batch.column(2).to_numpy(), batch.column(6).to_numpy()
            found = [lists.search(q, i, k) for q, i in zip(x, own.tolist(), strict=True)]
            sizes = [len(f[0]) for f in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(keys, sizes)), pa.array(np.repeat(own, sizes)), pa.array(block.ids[np.concatenate([f[0] for f in found])]),
                 pa.array(np.concatenate([f[1] for f in found]))], ["key", "query_id", "vec_id", "score"])

        return ask

    found = in_tiles(rows, asked, shape, start, "key bigint, query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
