"""Near-duplicate vectors by cosine: int8 tile products with error bounds.

Equal vectors are merged first and stand for their number. Distinct ones are put in cells
around pivot vectors and in blocks of bounded size within a cell. Block pairs of two cells are
compared unless the triangle inequality of angles rules out every link between the cells.
A tile product of int8 codes bounds every cosine; only pairs whose bound reaches the
threshold are computed in double precision. A tile reports sums and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickweir.llm.components import connected_components
from clickweir.llm.vectors import BLOCK_ROWS, SLACK, Block, blocks, cosines, estimates, usable, vector_type
from clickweir.session import stored

THRESHOLD = 0.9
GROUP_BLOCKS = 4     # blocks of a group
PIVOTS = 16     # cells; the pivots are the vectors of the smallest hashes, a bounded sample


def _nearest_pivot(pivots: np.ndarray):
    unit = pivots / np.sqrt((pivots * pivots).sum(axis=1))[:, None]

    def cells(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("vector"))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            cell, angle = np.zeros(len(sizes), "i8"), np.full(len(sizes), math.pi)
            own = np.flatnonzero(sizes == unit.shape[1])   # others keep cell 0 and its widest angle
            if len(own):
                x = lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1).astype("f8")
                cos = x @ unit.T / np.sqrt((x * x).sum(axis=1))[:, None]
                cell[own] = cos.argmax(axis=1)
                angle[own] = np.arccos(np.clip(cos.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)],
                                             [*batch.schema.names, "cell", "angle"])
    return cells


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node that links lead to, for n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_of_tile(x: Block, y: Block, same: bool, threshold: float, rows: int = 512):
    """ids, sums of linked weights, smallest id of the tile's component, for linked vectors."""
    ids = np.concatenate([x.ids, y.ids])
    sums = np.zeros(len(ids), "i8")
    label = np.arange(len(ids))
    step = len(x.ids)
    for at in range(0, len(x.ids), rows):
        part = Block(*[v[at:at + rows] for v in vars(x).values()])
        guess, error = estimates(part, y)
        limit = threshold - SLACK - 1e-6 - error[:, None] - (1 + error.max()) * y.error[None, :]
        i, j = np.nonzero(guess >= limit)
        if same:
            i, j = i[j > i + at], j[j > i + at]
        hit = cosines(part, i, y, j) >= threshold
        i, j = i[hit] + at, j[hit] + step
        np.add.at(sums, i, y.weight[j - step])
        np.add.at(sums, j, x.weight[i])
        if len(i):
            label = _forest(len(ids), np.concatenate([i, np.arange(len(ids))]), np.concatenate([j, label]))
    if same:   # both halves are the same vectors
        label = _forest(len(ids), np.concatenate([np.arange(len(ids)), np.arange(step)]),
                        np.concatenate([label, np.arange(step) + step]))
    least = np.full(len(ids), np.iinfo("i8").max)
    np.minimum.at(least, label, ids)
    some = sums > 0
    return ids[some], sums[some], least[label][some]


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS,
                 group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `df`.

    Null, empty or zero vectors, those with null or non-finite components and those without
    an id link with nothing and are kept; so do vectors of different lengths among each other. Repeated rows
    are vectors like others and link. An empty table gives no rows. Other columns are not read.
    """
    kind = vector_type(df, vector_col)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    good = usable(F.col("vector")) & F.col("id").isNotNull()
    merged = stored(rows.filter(good).groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("weight")),
                    "vectors")
    # one dimension has the pivots; with several lengths the others share cell 0
    sample = [r.vector for r in merged.orderBy(F.xxhash64("rep")).limit(pivots).select("vector").collect()]
    centres = np.array([v for v in sample if len(v) == len(sample[0])], "f8") if sample else np.ones((1, 1))
    put = stored(merged.select(F.col("rep").alias("id"), "weight", "vector").mapInArrow(
        _nearest_pivot(centres), f"id bigint, weight bigint, vector {kind}, cell bigint, angle double"), "cells")
    cells = {r.cell: r for r in put.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
    unit = centres / np.sqrt((centres * centres).sum(axis=1))[:, None]
    apart = np.arccos(np.clip(unit @ unit.T, -1, 1))
    reach = math.acos(threshold) + 1e-6
    spark = df.sparkSession
    n_blocks = {c: max(1, -(-r.n // block_rows)) for c, r in cells.items()}
    meets = spark.createDataFrame(
        [(c, n_blocks[c], [(d, n_blocks[d]) for d in cells
                           if apart[c, d] - cells[c].radius - cells[d].radius <= reach]) for c in cells],
        "cell bigint, n bigint, other array<struct<cell: bigint, n: bigint>>")   # at most `pivots` rows
    tiles = (put.join(F.broadcast(meets.select("cell", "n")), "cell")
             .withColumn("dim", F.size("vector"))
             .withColumn("sub", F.pmod(F.xxhash64("id"), "n")))
    made = stored(blocks(tiles, ["cell", "sub", "dim"]), "blocks")
    # a task compares all blocks of two groups, so a block is sent once for each group that its group meets
    own = F.struct("dim", "cell", F.expr(f"sub div {group_blocks}").alias("grp"))
    partner = F.struct("dim", "other.cell", F.col("other_grp").alias("grp"))
    paired = (made.join(F.broadcast(meets), "cell").withColumn("other", F.explode("other"))
              .withColumn("other_grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(other.n - 1) div {group_blocks}"))))
              .select(F.least(own, partner).alias("p"), F.greatest(own, partner).alias("q"), own.alias("me"), "sub", "block"))

    def compare(key, table):
        p, q = key[0].as_py(), key[1].as_py()
        parts = sorted(zip(table.column("sub").to_pylist(), table.column("me").to_pylist(), table.column("block").to_pylist()), key=lambda x: x[0])
        left = [Block.from_bytes(b) for _, me, b in parts if me == p]
        right = left if p == q else [Block.from_bytes(b) for _, me, b in parts if me == q]
        found = [links_of_tile(x, y, x is y, threshold) for i, x in enumerate(left) for y in (right[i:] if p == q else right)]
        ids, sums, least = (np.concatenate([np.zeros(0, "i8"), *[f[k] for f in found]]) for k in range(3))
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(sums, pa.int64()), "least": pa.array(least, pa.int64())})

    found = stored(paired.groupBy("p", "q").applyInArrow(compare, "id bigint, links bigint, least bigint"), "tile-links")
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), "vector-links")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    reps = (merged.join(sums, merged.rep == sums.id, "left").join(parts, F.col("rep") == F.col("node"), "left")
            .select(F.col("vector").alias("r_vector"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce("component", "rep").alias("component_id")))
    out = (rows.filter(good).join(reps, F.col("vector") == F.col("r_vector"))
           .select(F.col("id").alias("vec_id"), "n_links", "component_id"))
    alone = rows.filter(~good).select(F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"),
                                      F.col("id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
