"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded by A, a byte-level BPE, and by B, a piece model with byte fallback. Where tokens of both
end at the same byte, a group ends. An array maps each A id to the B id of the same bytes; groups of just such
a pair, most of all groups, are counted in vectors as long as A's vocabulary. Only the links of other groups
are counted as pairs and shuffled. A document's links are then looked up: those of the map and the pairs
that are frequent enough to be few in a broadcast table, others by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickweir.llm.byte_bpe import pieces, shared, token_bytes
from clickweir.llm.workers import releasing, ship_package
from clickweir.session import stored

SEGMENT = 1 << 18          # characters that are aligned together
HEAVY_PAIRS = 200_000      # pairs with at least one such part of all links are looked up without a shuffle
HELD_PAIRS = 1 << 20       # pair counts that a task holds before it adds them up
COUNTS = ("n_a", "n_b", "n_groups", "n_links")

MEASURED = ("key bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "same array<int>, same_n array<bigint>, pair array<bigint>, pair_n array<bigint>")


class Vocabularies:
    """Both tokenizers with the bytes of their tokens and the map of A ids to B ids of the same bytes."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece

        self.a = shared(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = token_bytes(a_json)
        self.n_b = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.n_b))]
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # a control id is never given out for a text; a piece goes before a byte of the same bytes
        order = sorted((i for i in range(self.n_b) if not self.b.is_control(i) and not self.b.is_unknown(i)),
                       key=lambda i: (not self.b.is_byte(i), -i))
        of_bytes = {self.b_bytes[i]: i for i in order}
        self.same = np.array([of_bytes.get(x, -1) if x else -1 for x in self.a_bytes])
        top = max(len(self.a_bytes), self.n_b)
        self.shown = np.array([b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(top)], dtype=object)
        self.top = top

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B for a space and the text, or None if their bytes are not those."""
        expected = b" " + text.encode()
        a = self.a.ids(" " + text)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != expected:
            return None
        b = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != expected:
            return None
        return a.astype("i8"), np.array(b, "i8")


@lru_cache(maxsize=1)
def vocabularies(a_json: str, b_model: bytes) -> Vocabularies:
    return Vocabularies(a_json, b_model)


def _per(key: np.ndarray, modulus: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, item, count) of the distinct keys segment * modulus + item."""
    key, n = np.unique(key, return_counts=True)
    return key // modulus, key % modulus, n


def align_tokens(v: Vocabularies, tokens: list[tuple[np.ndarray, np.ndarray]]):
    """Of segments with equal bytes on both sides: counts (n_a, n_b, n_groups, n_links) per segment, the groups of each as
    bytes with a `;` after each group, and two lists of (segment, item, count): A ids linked with the
    B id of the same bytes, and other linked pairs as a * n_b + b."""
    n_a, n_b = (np.array([len(t[side]) for t in tokens]) for side in (0, 1))
    a, b = (np.concatenate([t[side] for t in tokens]) for side in (0, 1))
    in_segment = np.repeat(np.arange(len(tokens)), n_a)
    a_end, b_end = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
    first = np.searchsorted(b_end, a_end - v.a_len[a], "right")     # the first and last B token on each A token
    last = np.searchsorted(b_end, a_end, "left")
    a_closes = b_end[last] == a_end
    b_closes = np.zeros(len(b), bool)
    b_closes[last[a_closes]] = True
    a_group = np.cumsum(a_closes) - a_closes
    b_group = np.cumsum(b_closes) - b_closes
    a_last, b_last = np.flatnonzero(a_closes), np.flatnonzero(b_closes)     # of every group
    a_first, b_first = np.append(0, a_last[:-1] + 1), np.append(0, b_last[:-1] + 1)

    links = last - first + 1
    n_links = np.bincount(in_segment, links, len(tokens)).astype("i8")
    n_groups = np.bincount(in_segment, a_closes, len(tokens)).astype("i8")

    single = (a_first == a_last) & (b_first == b_last) & (v.same[a[a_last]] == b[b_last])
    plain = single[a_group]
    odd = np.flatnonzero(~plain)
    on = np.repeat(odd, links[odd])
    step = np.arange(len(on)) - np.repeat(np.cumsum(links[odd]) - links[odd], links[odd])
    to = b[first[on] + step]
    mapped = v.same[a[on]] == to        # the same bytes at shifted places
    same = _per(np.concatenate([in_segment[plain], in_segment[on[mapped]]]) * len(v.a_bytes)
                + np.concatenate([a[plain], a[on[mapped]]]), len(v.a_bytes))
    pair = _per(in_segment[on[~mapped]] * (len(v.a_bytes) * v.n_b) + a[on[~mapped]] * v.n_b + to[~mapped], len(v.a_bytes) * v.n_b)

    row = np.empty(len(a) + len(b), "i8")
    row[np.arange(len(a)) + b_first[a_group]] = a + v.top * a_closes
    row[np.arange(len(b)) + a_last[b_group] + 1] = b + 2 * v.top * b_closes
    shown = v.shown[row]
    stops = np.cumsum(n_a + n_b)
    text = [b"".join(shown[stop - n:stop].tolist()) for stop, n in zip(stops, n_a + n_b)]
    return np.stack([n_a, n_b, n_groups, n_links], axis=1), text, same, pair


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Items and counts of all parts, added up."""
    items = np.concatenate([p[0] for p in parts])
    keys, at = np.unique(items, return_inverse=True)
    return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype("i8")


def _measure(batches: Iterable[pa.RecordBatch], a_json: str, b_model: bytes) -> Iterator[pa.RecordBatch]:
    v = vocabularies(a_json, b_model)
    base, made = TaskContext.get().partitionId() << 36, 0
    nothing = ([0, 0, 0, 0], "", [], [], [], [])

    def many(texts: list[str]) -> list[tuple]:
        """Rows of texts that are one segment each."""
        got = [v.tokens(t) if t else None for t in texts]
        valid = [i for i, g in enumerate(got) if g is not None]
        out = [nothing] * len(texts)
        if valid:
            counts, text, same, pair = align_tokens(v, [got[i] for i in valid])
            bounds = [np.searchsorted(x[0], np.arange(len(valid) + 1)) for x in (same, pair)]
            for k, i in enumerate(valid):
                s, p = (slice(x[k], x[k + 1]) for x in bounds)
                out[i] = (counts[k].tolist(), hashlib.sha256(text[k][:-1]).hexdigest(), same[1][s], same[2][s], pair[1][p], pair[2][p])
        return out

    def long(text: str) -> tuple:
        """The row of a text that is cut, where tokens of both begin at a space, in many segments."""
        total, digest, parts, before = np.zeros(4, "i8"), hashlib.sha256(), ([], []), b""
        for n, segment in enumerate(pieces(text, SEGMENT)):
            got = v.tokens(segment if n == 0 else segment[1:])
            if got is None:
                return nothing
            counts, groups, same, pair = align_tokens(v, [got])
            total += counts[0]
            digest.update(before + groups[0][:-1])
            before = b";"
            for held, new in zip(parts, (same, pair)):
                held.append(new[1:])
                if sum(len(x[0]) for x in held) > HELD_PAIRS:
                    held[:] = [_added(held)]
        (same, same_n), (pair, pair_n) = map(_added, parts)
        return total.tolist(), digest.hexdigest(), same, same_n, pair, pair_n

    def rows(ids: list, out: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        first, made = base + made, made + len(ids)
        counts = np.array([r[0] for r in out], "i8").reshape(-1, 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(first, first + len(ids))), pa.array(ids, pa.int64()), *[pa.array(counts[:, c]) for c in range(4)],
             pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.list_(pa.int32())),
             *[pa.array([r[c] for r in out], pa.list_(pa.int64())) for c in (3, 4, 5)]],
            ["key", "doc_id", *COUNTS, "groups_sha256", "same", "same_n", "pair", "pair_n"])

    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1)
        ids, some, chars = [], [], 0
        for name, text in zip(names, texts):
            text = text.as_py() or ""
            if len(text) > SEGMENT:
                yield rows([name], [long(text)])
                continue
            ids.append(name)
            some.append(text)
            chars += len(text) + 1
            if chars >= SEGMENT:
                yield rows(ids, many(some))
                ids, some, chars = [], [], 0
        if ids:
            yield rows(ids, many(some))


def measure(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its own counts, groups and linked ids; written, as it is read three times."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return stored(rows.mapInArrow(releasing(lambda b: _measure(b, a_json, b_model)), MEASURED), "aligned")


def _totals(batches: Iterable[pa.RecordBatch], a_json: str, b_model: bytes) -> Iterator[pa.RecordBatch]:
    """A vector of A's vocabulary and a table of pairs per task."""
    v = vocabularies(a_json, b_model)
    vector = np.zeros(len(v.a_bytes), "i8")
    held: list = []
    size = 0
    for batch in batches:
        same, same_n, pair, pair_n = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
        np.add.at(vector, same, same_n)
        held.append((pair, pair_n))
        size += len(pair)
        if size > HELD_PAIRS:
            held = [_added(held)]
            size = len(held[0][0])
            if size > HELD_PAIRS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["pair", "n"])
                held, size = [], 0
    ids = np.flatnonzero(vector)
    yield pa.RecordBatch.from_arrays([pa.array(ids * v.n_b + v.same[ids]), pa.array(vector[ids])], ["pair", "n"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _added(held)], ["pair", "n"])


def pair_totals(measured: DataFrame, a_json: str, b_model: bytes) -> DataFrame:
    """pair (a * pieces of B + b), n, best: how many links hold each linked pair of ids, and whether no
    other pair of its B id has more. This is the map from one vocabulary to the other."""
    n_b = vocabularies(a_json, b_model).n_b
    added = stored(measured.select("same", "same_n", "pair", "pair_n")
                   .mapInArrow(releasing(lambda b: _totals(b, a_json, b_model)), "pair bigint, n bigint")
                   .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    most = added.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    return (added.join(F.broadcast(most), F.col("pair") % n_b == F.col("b"))      # a row per B id at most
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _look_up(batches: Iterable[pa.RecordBatch], pairs: np.ndarray, n: np.ndarray, best: np.ndarray,
             a_json: str, b_model: bytes) -> Iterator[pa.RecordBatch]:
    """(key, null, n_best, count_sum) of each document's known pairs, (key, pair, count, null) of others."""
    v = vocabularies(a_json, b_model)
    for batch in batches:
        keys = batch.column(0).to_numpy()
        sums = np.zeros((2, len(keys)), "i8")
        for items, counts in ((1, 2), (3, 4)):
            lists = batch.column(items)
            row = np.repeat(np.arange(len(keys)), pc.list_value_length(lists).to_numpy())
            item, count = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (items, counts))
            if items == 1:
                item = item.astype("i8") * v.n_b + v.same[item]
            at = np.searchsorted(pairs, item)
            known = (pairs[np.minimum(at, len(pairs) - 1)] == item) if len(pairs) else np.zeros(len(item), bool)
            found = at[known]
            np.add.at(sums[0], row[known], count[known] * best[found])
            np.add.at(sums[1], row[known], count[known] * n[found])
            if not known.all():
                some = int((~known).sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row[~known]]), pa.array(item[~known]), pa.array(count[~known]), pa.nulls(some, pa.int64())],
                    ["key", "pair", "x", "y"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.nulls(len(keys), pa.int64()), pa.array(sums[0]), pa.array(sums[1])], ["key", "pair", "x", "y"])


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
          heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of `docs`.

    `a_json` is the text of a byte-level BPE file, `b_model` the bytes of a piece model that puts a space before a text. A
    text that is null, empty, or whose tokens don't join to a space and the text has no tokens: zeros and an
    empty string. A null id stays null; repeated rows are rows of their own, and all of them count. Very long texts
    are aligned in segments, cut at single spaces; a text without any is one segment. An empty table gives no rows.
    Other columns are not read.

    A pair that holds one of `heavy_pairs` parts of all links or more is broadcast, with the pairs of the map: there are
    at most so many, and A's vocabulary. Every other pair is rare by this measure, so the join on pairs has no hot key.
    """
    spark = docs.sparkSession
    v = vocabularies(a_json, b_model)
    measured = measure(docs, a_json, b_model, id_col, text_col)
    totals = stored(pair_totals(measured, a_json, b_model), "pair-totals")
    links = totals.agg(F.sum("n")).first()[0] or 0
    mapped = pa.table({"pair": np.flatnonzero(v.same >= 0) * v.n_b + v.same[v.same >= 0], "mapped": np.ones((v.same >= 0).sum(), bool)})
    marked = totals.join(F.broadcast(spark.createDataFrame(mapped)), "pair", "left")
    looked_up = F.coalesce("mapped", F.lit(False)) | (F.col("n") * heavy_pairs >= links)
    few = marked.filter(looked_up).select("pair", "n", "best").orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast([few.column(c).to_numpy() for c in range(3)])
    parts = stored(measured.select("key", "same", "same_n", "pair", "pair_n").mapInArrow(
        releasing(lambda b: _look_up(b, *table.value, a_json, b_model)), "key bigint, pair bigint, x bigint, y bigint"), "link-parts")
    rare = marked.filter(~looked_up).select("pair", "n", "best")
    joined = (parts.filter("pair IS NOT NULL").join(rare, "pair")
              .select("key", F.when(F.col("best"), F.col("x")).otherwise(F.lit(0)).alias("n_best"), (F.col("x") * F.col("n")).alias("count_sum")))
    sums = (parts.filter("pair IS NULL").select("key", F.col("x").alias("n_best"), F.col("y").alias("count_sum")).unionAll(joined)
            .groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return measured.join(sums, "key").select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
