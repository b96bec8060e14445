"""Nearest neighbours by block matrix join.

Blocks of queries meet groups of candidate blocks, by block number. In a tile the int8
product estimates every cosine within an error bound. Candidates whose upper bound is below
the k-th largest lower bound of their query, over all tiles of the group so far, drop out; the
others are computed in double precision and merged into the query's heap.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from clickweir.llm.vectors import BLOCK_ROWS, SLACK, Block, blocks, cosines, estimates, usable, vector_type
from clickweir.session import stored

QUERY_ROWS = 1024
GROUP_BLOCKS = 4    # candidate blocks that one task compares with a query block, one after another


def _distinct(block: Block, k: int) -> Block:
    """Of equal vectors only the k+1 smallest ids can be among the k nearest of any query."""
    _, same = np.unique(block.vectors, axis=0, return_inverse=True)
    order = np.argsort(same.ravel(), kind="stable")   # ids ascend in a block
    first = np.r_[True, np.diff(same.ravel()[order]) > 0]
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    keep = np.sort(order[place <= k])
    return Block(*[v[keep] for v in vars(block).values()])


def merge_tile(queries: Block, block: Block, heaps: list[list[tuple[float, int]]], k: int) -> None:
    """Add a tile to the heaps of (cosine, -id), whose head is the worst kept."""
    guess, error = estimates(queries, block)
    bound = error[:, None] + (1 + error[:, None]) * block.error[None, :] + SLACK + 1e-6
    n = min(k + 1, guess.shape[1])   # one more, the query itself may be among them
    lower = np.partition(guess - bound, guess.shape[1] - n, axis=1)[:, guess.shape[1] - n] if guess.shape[1] > k else \
        np.full(len(heaps), -2.0)
    held = np.array([h[0][0] if len(h) == k else -2.0 for h in heaps])
    i, j = np.nonzero(guess + bound >= np.maximum(lower, held - 1e-12)[:, None])
    other = queries.ids[i] != block.ids[j]
    i, j = i[other], j[other]
    for q, c, score in zip(i.tolist(), block.ids[j].tolist(), cosines(queries, i, block, j).tolist()):
        heap, item = heaps[q], (score, -c)
        if len(heap) < k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of the largest cosine, ties to the smaller id.

    `is_query` is a condition on columns of `df`. Vectors that are null, empty or zero, have null or
    non-finite components, or no id, take no part; queries without any candidate give no
    rows. Rows that repeat id and vector count once; a query's own id is no candidate. Only
    vectors of one length are compared. An empty table gives no rows. Every pair of a query
    and a candidate goes through a tile, so nothing is missed.
    """
    rows = (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(vector_type(df, vector_col)).alias("vector"),
                      F.coalesce(is_query, F.lit(False)).alias("asks"))
            .filter(usable(F.col("vector")) & F.col("id").isNotNull())
            .groupBy("id", "vector").agg(F.max("asks").alias("asks"))
            .select("id", F.lit(1).cast("bigint").alias("weight"), "vector", "asks", F.size("vector").alias("dim")))
    rows = stored(rows, "search-vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    n_blocks, n_asking = max(1, -(-n // block_rows)), max(1, -(-asked // query_rows))

    def cut(part: DataFrame, number: int) -> DataFrame:
        return blocks(part.withColumn("sub", F.pmod(F.xxhash64("id", "vector"), F.lit(number))), ["dim", "sub"])

    groups = -(-n_blocks // group_blocks)
    candidates = (cut(rows, n_blocks).withColumn("grp", F.expr(f"sub div {group_blocks}"))
                  .withColumn("asking", F.explode(F.sequence(F.lit(0), F.lit(n_asking - 1)))).withColumn("query", F.lit(False)))
    asking = (cut(rows.filter("asks"), n_asking).withColumn("asking", F.col("sub").cast("int"))
              .withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
              .withColumn("query", F.lit(True)))
    columns = ["dim", "asking", "grp", "query", "sub", "block"]

    def search(key, table):
        parts = sorted(zip(table.column("query").to_pylist(), table.column("sub").to_pylist(),
                           table.column("block").to_pylist()), key=lambda p: (not p[0], p[1]))
        out: list[tuple[int, int, float]] = []
        if parts and parts[0][0]:
            queries = Block.from_bytes(parts[0][2])
            heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
            for _, _, data in parts[1:]:
                merge_tile(queries, _distinct(Block.from_bytes(data), k), heaps, k)
            out = [(int(q), -c, s) for q, heap in zip(queries.ids, heaps) for s, c in heap]
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()),
                         "vec_id": pa.array([o[1] for o in out], pa.int64()),
                         "score": pa.array([o[2] for o in out], pa.float64())})

    found = candidates.select(columns).union(asking.select(columns)).groupBy("dim", "asking", "grp") \
        .applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
