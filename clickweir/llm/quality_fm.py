"""Quality scores by a factorisation machine.

Features are hashed words, weighted by the logarithm of their number in the text, and
statistics of the text's structure and the given length, cut into bins. Every feature has a
weight and a short vector; pairs of features interact by the inner product of their vectors, summed in
linear time as half of (sum of v*x) squared less the sum of (v*x) squared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickweir.llm.utf8 import LOWER, owner, pieces

LEARNED_ROWS = 4000    # labelled texts that are learned from: those of the smallest id hashes
WORD_BITS = 14         # of the hashed words
BINS = 10              # of a statistic
FACTORS = 8
STEPS = 80
LEARNING_RATE = 0.05
DECAY = 1e-4
KEPT_POWERS = 1 << 18
STATISTICS = ("bytes", "words", "word length", "upper-case", "digits", "line ends", "marks", "symbols",
              "distinct words", "words repeated at once", "most frequent word", "words without letter",
              "given length", "given length by bytes")

# Classes of bytes: 1 lower-case or part of a longer character, 2 upper-case, 3 digit, 4 blank, 5 line end, 6 mark, 7 symbol
_CLASS = np.full(256, 7, "u1")
_CLASS[128:] = 1
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 4, 5
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 6
_ODD = 0x9E3779B97F4A7C15                        # an odd multiplier has an inverse modulo 2**64
_BACK = pow(_ODD, -1, 1 << 64)


@lru_cache(maxsize=6)
def _first_powers(base: int) -> np.ndarray:
    out = np.full(KEPT_POWERS, base, "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64. Only so many as an ordinary piece needs are kept."""
    first = _first_powers(base)
    if n <= len(first):
        return first[:n]
    step = np.uint64(pow(base, KEPT_POWERS, 1 << 64))
    out = np.empty(n, "u8")
    out[:KEPT_POWERS] = first
    for at in range(KEPT_POWERS, n, KEPT_POWERS):
        size = min(KEPT_POWERS, n - at)
        np.multiply(out[at - KEPT_POWERS:at - KEPT_POWERS + size], step, out=out[at:at + size])
    return out


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, end) of the words of a piece; no word crosses texts."""
    solid = (_CLASS[data] != 4) & (_CLASS[data] != 5)
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begins = solid & (np.r_[True, ~solid[:-1]] | cut[:-1])
    ends = solid & (np.r_[~solid[1:], True] | cut[1:])
    first = np.flatnonzero(begins)
    return np.searchsorted(starts, first, "right") - 1, first, np.flatnonzero(ends) + 1


def running_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of the piece follows."""
    low = LOWER[data].astype("u8") + np.uint64(1)
    low *= _powers(_ODD, len(data))
    return np.concatenate([np.zeros(1, "u8"), np.cumsum(low)])


def stretch_hashes(run: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each stretch, A-Z as a-z."""
    h = (run[end] - run[first]) * _powers(_BACK, len(run))[first]
    h ^= h >> np.uint64(29)
    h *= np.uint64(_ODD)
    return h ^ (h >> np.uint64(32))


@dataclass
class Features:
    stats: np.ndarray     # texts x STATISTICS
    starts: np.ndarray    # where each text's words begin below
    bucket: np.ndarray
    count: np.ndarray


def features(data: np.ndarray, starts: np.ndarray, given: np.ndarray) -> Features:
    """Of the texts of a piece; `given` is their stated length or -1."""
    n = len(starts) - 1
    sizes = np.diff(starts).astype("f8")
    kinds = np.bincount(owner(starts) * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8).astype("f8")
    text, first, end = words(data, starts)
    h = stretch_hashes(running_hash(data), first, end)
    letter = np.concatenate([[0], np.cumsum(_CLASS[data] <= 2)])
    total = np.bincount(text, minlength=n).astype("f8")
    some = np.maximum(total, 1)
    again = np.bincount(text[1:][(h[1:] == h[:-1]) & (text[1:] == text[:-1])], minlength=n)
    blank = np.bincount(text[letter[end] == letter[first]], minlength=n)
    keys, count = np.unique((text << 32) | (h >> np.uint64(64 - 32)).astype("i8"), return_counts=True)
    of = keys >> 32
    distinct = np.bincount(of, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, of, count)
    byte = np.maximum(sizes, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    stats = np.column_stack([
        np.log1p(sizes), np.log1p(total), (sizes - kinds[:, 4] - kinds[:, 5]) / some, kinds[:, 2] / letters,
        kinds[:, 3] / byte, kinds[:, 5] / byte, kinds[:, 6] / byte, kinds[:, 7] / byte, distinct / some, again / some,
        most / some, blank / some, np.where(given < 0, -1, np.log1p(np.maximum(given, 0))), given / byte])
    return Features(stats, np.searchsorted(of, np.arange(n + 1)), (keys & 0xFFFFFFFF) >> (32 - WORD_BITS), count)


@dataclass
class Machine:
    edges: list[np.ndarray]    # of the statistics' bins
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def rows(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, feature, value) of all texts: their bins, then their words."""
        return rows_of(self.edges, f)

    def logits(self, f: Features) -> np.ndarray:
        starts, index, value = self.rows(f)
        vx = self.factor[index] * value[:, None]
        s = np.add.reduceat(vx, starts[:-1])
        return (self.bias + np.add.reduceat(self.weight[index] * value, starts[:-1])
                + 0.5 * (s * s - np.add.reduceat(vx * vx, starts[:-1])).sum(axis=1))

    def scores(self, f: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(f), -30, 30)))


def rows_of(edges: list[np.ndarray], f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = f.stats.shape
    bins = np.column_stack([np.searchsorted(e, f.stats[:, i], "right") for i, e in enumerate(edges)])
    bins += (np.arange(k) * (BINS + 1))[None, :] + (1 << WORD_BITS)
    value = np.log1p(f.count)
    text = np.repeat(np.arange(n), np.diff(f.starts))
    norm = np.sqrt(np.bincount(text, value * value, minlength=n))
    starts = f.starts + np.arange(n + 1) * k
    index, out = np.empty(starts[-1], "i8"), np.empty(starts[-1])
    own = (starts[:-1, None] + np.arange(k)[None, :]).ravel()
    index[own], out[own] = bins.ravel(), 1 / np.sqrt(k)
    rest = np.ones(len(index), bool)
    rest[own] = False
    index[rest], out[rest] = f.bucket, value / np.maximum(norm[text], 1e-9)
    return starts, index, out


def fit(f: Features, label: np.ndarray, factors: int = FACTORS, steps: int = STEPS, rate: float = LEARNING_RATE,
        decay: float = DECAY) -> Machine:
    """Log-loss by full-batch Adam. Without texts, or with one label alone, the score is their mean."""
    size = (1 << WORD_BITS) + len(STATISTICS) * (BINS + 1)
    mean = float(label.mean()) if len(label) else 0.5
    bias = float(np.log(np.clip(mean, 1e-3, 1 - 1e-3) / (1 - np.clip(mean, 1e-3, 1 - 1e-3))))
    edges = [np.unique(np.quantile(f.stats[:, i], np.linspace(0, 1, BINS + 1)[1:])) if len(label) else np.zeros(1)
             for i in range(len(STATISTICS))]
    params = {"b": np.array([bias]), "w": np.zeros(size),
              "v": np.random.default_rng(1).normal(0, 0.05, (size, factors)).astype("f4")}
    if not len(label) or not 0 < mean < 1:
        params["v"][:] = 0
    else:
        starts, index, value = rows_of(edges, f)
        value = value.astype("f4")      # the driver holds a few arrays of all values times the factors
        text = np.repeat(np.arange(len(label)), np.diff(starts))
        order = np.argsort(index, kind="stable")
        used, at = np.unique(index[order], return_index=True)
        held = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in params.items()}
        for t in range(1, steps + 1):
            vx = params["v"][index] * value[:, None]
            s = np.add.reduceat(vx, starts[:-1])
            z = (params["b"][0] + np.add.reduceat(params["w"][index] * value, starts[:-1])
                 + 0.5 * (s * s - np.add.reduceat(vx * vx, starts[:-1])).sum(axis=1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
            g = g.astype("f4")
            gx = g[text] * value
            grad = {"b": np.array([g.sum()]), "w": decay * params["w"], "v": decay * params["v"]}
            grad["w"][used] += np.add.reduceat(gx[order], at)
            grad["v"][used] += np.add.reduceat((gx[:, None] * (s[text] - vx))[order], at)
            for k, p in params.items():
                m, v = held[k]
                m += 0.1 * (grad[k] - m)
                v += 0.001 * (grad[k] ** 2 - v)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Machine(edges, float(params["b"][0]), params["w"], params["v"])


def _given(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)


def learned(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, length_col: str,
            label_col: str, rows: int) -> tuple[Features, np.ndarray]:
    """Features and labels of at most `rows` labelled texts, counted on the executors."""
    chosen = (labels.filter(learn & F.col(label_col).isNotNull())
              .select(F.col(id_col).alias("chosen"), F.col(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("chosen"), "label").limit(rows))    # so many rows at most
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("chosen")).select(
        "label", F.col(text_col).cast("string"), F.col(length_col).cast("double"))

    def run(batches):
        for batch in batches:
            for part, data, starts in pieces(batch.column(1)):
                f = features(data, starts, _given(batch.column(2)[part]))
                cut = f.starts.astype("i4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(list(f.stats), pa.list_(pa.float64())),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(f.bucket.astype("i4"))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(f.count.astype("i4")))],
                    ["label", "stats", "bucket", "count"])

    got = sample.mapInArrow(run, "label double, stats array<double>, bucket array<int>, count array<int>").toArrow()
    order = sorted(range(got.num_rows), key=lambda i: (got["label"][i].as_py(), got["stats"][i].as_py(), got["bucket"][i].as_py()))
    got = got.take(pa.array(order, pa.int64())).combine_chunks()
    lists = [got[c].combine_chunks() for c in ("stats", "bucket", "count")]
    sizes = lists[1].value_lengths().to_numpy(zero_copy_only=False)
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
    return (Features(flat[0].reshape(-1, len(STATISTICS)), np.r_[0, np.cumsum(sizes)].astype("i8"),
                     flat[1].astype("i8"), flat[2].astype("i8")), got["label"].to_numpy())


def score(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          length_col: str = "n_chars", label_col: str = "quality", learned_rows: int = LEARNED_ROWS) -> DataFrame:
    """doc_id, score: the probability of label 1, one row per row of `docs`.

    `labels` has the id and the label; rows that meet `learn` and have a label are learned from, at most
    `learned_rows` of them. Text, null like empty, and the stated length, which may be null, are
    the only inputs of a score. Repeated rows and ids count as rows. Whole texts are read, however long. An empty
    table gives no rows; without labels every score is 0.5. Other columns are not read.
    """
    machine = fit(*learned(docs, labels, learn, id_col, text_col, length_col, label_col, learned_rows))

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for part, data, starts in pieces(batch.column(1)):
                out[part] = machine.scores(features(data, starts, _given(batch.column(2)[part])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string"),
                       F.col(length_col).cast("double")).mapInArrow(run, "doc_id bigint, score double")
