"""Blocks of int8-quantised vectors, their error bounds and block-pair joins.

A unit vector x is held as s*q with int8 q and a scale s. With e = |x - s*q|, known for each
vector, the inner product of x and y differs from s_x*s_y*(q_x.q_y) by at most
e_x + (1 + e_x)*e_y. Products of int8 codes are integers below 2**24 for up to
1,000 dimensions, so single-precision matrix products give them exactly; longer vectors are multiplied in parts
of 1,000, which are added in double precision.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_ROWS = 4096
EXACT_DIMENSIONS = 1000
SLACK = 1e-7      # above all rounding in bounds and scaled products


def usable(vector: Column) -> Column:
    """Not null, every component finite, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def vector_type(df: DataFrame, vector_col: str) -> str:
    """Arrays of single precision stay so, others become arrays of double precision."""
    kind = df.schema[vector_col].dataType
    return "array<float>" if kind.simpleString() == "array<float>" else "array<double>"


@dataclass
class Block:
    ids: np.ndarray        # int64
    weight: np.ndarray     # int64, rows that a vector stands for
    vectors: np.ndarray    # float64, original
    norms: np.ndarray      # float64
    codes: np.ndarray      # int8
    scale: np.ndarray      # float64
    error: np.ndarray      # float64

    @classmethod
    def of(cls, ids, weight, vectors) -> "Block":
        x = np.asarray(vectors, "f8")
        norms = np.sqrt((x * x).sum(axis=1))
        unit = x / norms[:, None]
        scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / scale[:, None]).astype("i1")
        error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1))
        return cls(np.asarray(ids, "i8"), np.asarray(weight, "i8"), x, norms, codes, scale, error)

    def to_bytes(self) -> bytes:
        """Original vectors, in single precision if that holds them; the rest follows from them."""
        out = io.BytesIO()
        single = self.vectors.astype("f4")
        np.savez(out, ids=self.ids, weight=self.weight, vectors=single if (single == self.vectors).all() else self.vectors)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Block":
        with np.load(io.BytesIO(data)) as z:
            return cls.of(z["ids"], z["weight"], z["vectors"])


def estimates(x: Block, y: Block) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of all pairs, and per row of x the largest error over y."""
    a, b = x.codes.astype("f4"), y.codes.astype("f4")
    if a.shape[1] <= EXACT_DIMENSIONS:
        product = a @ b.T
    else:
        product = np.zeros((len(a), len(b)))
        for at in range(0, a.shape[1], EXACT_DIMENSIONS):
            product += a[:, at:at + EXACT_DIMENSIONS] @ b[:, at:at + EXACT_DIMENSIONS].T
    product *= x.scale.astype("f4")[:, None]
    product *= y.scale.astype("f4")[None, :]
    return product, x.error


def cosines(x: Block, i: np.ndarray, y: Block, j: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
    """Cosines of pairs in double precision from the original vectors."""
    out = np.empty(len(i))
    for at in range(0, len(i), chunk):
        a, b = i[at:at + chunk], j[at:at + chunk]
        out[at:at + chunk] = (x.vectors[a] * y.vectors[b]).sum(axis=1) / (x.norms[a] * y.norms[b])
    return out


def blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the block of its vectors; `df` has keys, id, weight, vector."""
    schema = ", ".join(f"{k} bigint" for k in keys) + ", block binary"

    def build(key, table):
        flat = table.column("vector").combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        x = flat.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        order = np.argsort(ids := table.column("id").to_numpy(), kind="stable")
        block = Block.of(ids[order], table.column("weight").to_numpy()[order], x[order])
        return pa.table({**{k: pa.array([v.as_py()], pa.int64()) for k, v in zip(keys, key)},
                         "block": pa.array([block.to_bytes()], pa.binary())})

    return df.select(*[F.col(k).cast("bigint") for k in keys], "id", "weight", "vector") \
        .groupBy(*keys).applyInArrow(build, schema)
