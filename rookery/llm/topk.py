"""Exact top-k inner products by aggregating sorted lists without random access.

Every component of the candidates is a list sorted by value. A query reads each list from
the end that helps it most, all lists to the same depth, and keeps for every candidate a
lower and an upper bound of its score: an entry that was read counts as it is, one that
was not is no better than the last value read and no worse than the far end of its list.
Reading goes deeper until few candidates can still qualify; their scores are then resolved
exactly. Reading to the full depth is the worst case, so the result is exact always.

For a group of queries and a block of candidates both bounds are matrix products: an
unread entry of a list read downwards to ``t`` is below ``t``, hence ``max(x, t)`` is its
upper value.

Queries and candidates are cut into groups of bounded size. Each cell (query group,
candidate group) is one unit of work and keeps k rows per query; a rank filter over the
cells' rows gives the result.

Vectors that are null or hold a null, NaN or infinity take no part. Only vectors of the same
length are compared. A row whose id is the query's own never answers it, repeated rows
included; otherwise rows with one id are separate rows. Equal scores go to the smaller id. An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

QUERY_GROUP = 512
CANDIDATE_GROUP = 8192
DEPTHS = (0.5, 0.75, 0.875)
RESULT = "query_id LONG, vec_id LONG, score LONG"


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.dtype:
    """A type in which products and their sums stay exact; floats run on BLAS."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    most *= max(1, rows.shape[1])
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


def cell_top(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of one block for every query: query index, row index, score."""
    kind = _exact(queries, rows)
    if not rows.shape[1]:
        queries, rows = np.zeros((len(queries), 1)), np.zeros((len(rows), 1))
    lists = np.sort(rows, axis=0).astype(kind)
    queries, rows = queries.astype(kind), rows.astype(kind)
    gain, loss = np.maximum(queries, 0), np.minimum(queries, 0)
    both = np.concatenate([gain, loss], axis=1)
    low, high = lists[0], lists[-1]
    alive, floor = np.ones(len(queries), bool), np.full(len(queries), -np.inf)
    own = query_ids[:, None] == row_ids[None, :]
    keep = None
    for depth in DEPTHS if len(rows) > 4 * k else ():
        last = min(len(rows) - 1, int(depth * len(rows)))
        top, bottom = lists[len(rows) - 1 - last], lists[last]
        upper = both @ np.concatenate([np.maximum(rows, top), np.minimum(rows, bottom)], axis=1).T
        lower = both @ np.concatenate(
            [np.where(rows >= top, rows, low), np.where(rows <= bottom, rows, high)], axis=1
        ).T
        lower[own] = -np.inf
        floor = np.maximum(floor, np.partition(lower, len(rows) - k, axis=1)[:, len(rows) - k])
        keep = upper >= floor[:, None]
        alive = keep.sum(axis=1) > len(rows) // 16
        if not alive.any():
            break
    keep = np.ones(own.shape, bool) if keep is None else keep
    keep &= ~own
    where, which = np.nonzero(keep)
    if len(where) * 8 > keep.size:
        scores = (queries @ rows.T)[where, which]
    else:
        scores = np.empty(len(where), kind)
        for begin in range(0, len(where), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            scores[part] = np.einsum("ij,ij->i", queries[where[part]], rows[which[part]])
    order = np.lexsort((row_ids[which], -scores, where))
    where, which, scores = where[order], which[order], scores[order]
    rank = np.arange(len(where)) - np.searchsorted(where, where)
    best = rank < k
    return where[best], which[best], scores[best].astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0].values) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _cells(k: int):
    def work(queries: pa.Table, rows: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        if not queries.num_rows or not rows.num_rows:
            return empty
        left, right = queries.combine_chunks(), rows.combine_chunks()
        query_ids, row_ids = left["id"].to_numpy(), right["id"].to_numpy()
        where, which, scores = cell_top(
            _matrix(left["v"].chunk(0)), query_ids, _matrix(right["v"].chunk(0)), row_ids, k
        )
        return pa.table({"query_id": query_ids[where], "vec_id": row_ids[which], "score": scores})

    return work


def _every(groups: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))


def top_k(vectors: DataFrame, id_column: str, vector: str, is_query: Column, k: int) -> DataFrame:
    """The k best other rows of every row that ``is_query`` selects.

    ``vector`` is an array of integers (long). Returns query_id, rank from 1, vec_id, score.
    """
    spark = vectors.sparkSession
    whole = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector).cast("array<long>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & ~F.exists(F.coalesce(F.col("v"), F.array()), lambda x: x.isNull())
    )
    total = whole.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    row_groups = -(-max(1, total["n"]) // CANDIDATE_GROUP)
    query_groups = -(-max(1, total["q"]) // QUERY_GROUP)
    # By place in the input, not by id: groups stay even when one id holds many rows.
    place = F.xxhash64(F.monotonically_increasing_id())
    sized = whole.withColumns({"d": F.size("v"), "place": place})
    rows = sized.withColumn("g", F.pmod("place", F.lit(row_groups))).select(
        "id", "v", "d", "g", F.explode(_every(query_groups)).alias("r")
    )
    queries = sized.filter("asks").withColumn("r", F.pmod("place", F.lit(query_groups))).select(
        "id", "v", "d", F.explode(_every(row_groups)).alias("g"), "r"
    )
    found = (
        queries.groupBy("d", "g", "r")
        .cogroup(rows.groupBy("d", "g", "r"))
        .applyInArrow(_cells(k), RESULT)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
