"""Exact top-k inner products by columnar branch-and-bound.

Vectors become integers, floor(scale * x). Queries and candidates meet in cells of a grid, a
block of one against a block of the other. A cell holds its candidates dimension by dimension
(vertical layout) and adds up the products block of dimensions by block; after each block the
norms of the remaining dimensions bound what a candidate can still gain or lose, and the ones
that cannot reach the k-th best any more are compacted away. Cells give k rows per query at
most, of which the best k stay.

Defined cases: vectors that are null or hold null, NaN or infinite components, and rows
without an id, take no part; rows that repeat an id are one row, the one with the smallest
vector; vectors are compared with those of their own length only; equal scores go to the
smaller id; scores beyond 64 bits stop at the largest; with fewer than k candidates all are
returned. Only vec_id and embedding are read, so names of other columns cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
CANDIDATES, LEAST_BLOCKS = 4096, 16  # candidates of a cell at most; blocks of them at least
QUERIES = 1024  # queries of a cell
STEP = 8  # dimensions added up between two compactions
_MOST = (1 << 63) - 1
_CELL = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and its length, for the rows that take part."""
    sound = F.forall(
        "embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    doubles = F.col("embedding").cast("array<double>")
    return (
        vectors.select(F.col("vec_id").cast("long"), doubles.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("dims", F.size("embedding"))
    )


def best_in_block(query: np.ndarray, own: int, columns: np.ndarray, rest: np.ndarray, ids: np.ndarray, k: int):
    """Ids and scores of the k best candidates of a block for one query.

    `columns` holds the candidates by dimension, `rest[b]` their norms from dimension b*STEP on.
    """
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive))
    squares = np.append(np.cumsum((query * query)[::-1])[::-1], 0.0)
    for b, start in enumerate(range(0, len(query), STEP)):
        stop = min(start + STEP, len(query))
        score += query[start:stop] @ columns[start:stop, alive]
        if len(alive) > k and stop < len(query):
            swing = np.sqrt(squares[stop]) * rest[b + 1, alive] * (1 + 1e-9) + 1e-6
            least = score - swing
            cut = np.partition(least, len(least) - k)[len(least) - k]
            stay = np.flatnonzero(score + swing >= cut)
            if len(stay) < len(alive):
                alive, score = alive[stay], score[stay]
    best = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[best]], score[best].astype(np.int64)


def search_cell(queries: np.ndarray, query_ids: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int):
    """(query id, id, score) of the best of a block for each query; vectors are rows of integers."""
    dims = queries.shape[1]
    out = []
    largest = [max(float(np.abs(m).max(initial=0)), 1.0) for m in (queries, block)]
    if np.log2(largest).sum() + np.log2(max(dims, 1)) >= 52:  # sums that doubles don't hold: whole numbers of any size
        whole = [[int(x) for x in row] for row in block]
        for own, query in zip(query_ids, queries, strict=True):
            q = [int(x) for x in query]
            scores = [
                (-max(-_MOST - 1, min(_MOST, sum(a * b for a, b in zip(q, row, strict=True)))), i)
                for i, row in zip(ids.tolist(), whole, strict=True)
                if i != own
            ]
            out += [(int(own), i, -s) for s, i in sorted(scores)[:k]]
        return out
    columns = np.ascontiguousarray(block.T)
    marks = range(0, dims, STEP)
    rest = np.sqrt(np.array([(columns[m:] ** 2).sum(axis=0) for m in marks])) if dims else np.zeros((0, len(ids)))
    for own, query in zip(query_ids, queries, strict=True):
        found, scores = best_in_block(query, own, columns, rest, ids, k)
        out += [(int(own), i, s) for i, s in zip(found.tolist(), scores.tolist(), strict=True)]
    return out


def _matrix(table: pa.Table, scale: int) -> np.ndarray:
    flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    dims = table["dims"][0].as_py() if table.num_rows else 0
    return np.floor(scale * flat.astype(np.float64)).reshape(table.num_rows, dims)


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank from 1, vec_id and score; `is_query` is a condition on vec_id."""
    rows = usable(vectors)
    asked = rows.where(is_query)
    sizes = rows.agg(F.count("*"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    size = max(1, min(CANDIDATES, -(-sizes[0] // LEAST_BLOCKS)))
    blocks, groups = max(1, -(-sizes[0] // size)), max(1, -(-sizes[1] // QUERIES))
    mine = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("group", mine(groups, 1)).withColumn("block", every(blocks))
    right = rows.withColumn("block", mine(blocks, 2)).withColumn("group", every(groups))

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and candidates.num_rows:
            found = search_cell(
                _matrix(queries, scale), queries["vec_id"].to_numpy(),
                _matrix(candidates, scale), candidates["vec_id"].to_numpy(), k,
            )
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    keys = ["dims", "group", "block"]
    cells = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, _CELL)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
