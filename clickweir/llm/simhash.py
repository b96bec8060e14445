"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints of 64 bits are cut into six blocks. Two that differ in at most three bits agree
in at least three blocks, so joining on each choice of three blocks, 20 keys of about 32 bits,
finds all close pairs. Fingerprints are made distinct first. Rows of a key are compared
where they are sorted together; what comes out is a spanning forest, never the pairs.
A key with very many fingerprints is cut by the same rule within its other 32 bits; what then
shares a key differs in 16 bits alone, so no group can exceed 65,536 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweir.llm.components import connected_components
from clickweir.llm.workers import releasing
from clickweir.session import stored

SHINGLE = 3
SEED = 42
MOST_BITS = 3
HOT_KEY = 8192     # fingerprints of a key that are still compared together
TILE = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    # of bytes, lower() changes A-Z alone and split() cuts at 0x20 and 0x09-0x0D alone
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    parts = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
    hashes = np.array([xxh64_intdigest(b" ".join(p), seed) for p in parts], "<u8")
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at:at + (1 << 15)].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="u4")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tie, fp: the fingerprint as a signed long and a hash of the text, one row per row."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "tie", "fp"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), text).mapInArrow(
        releasing(run), "doc_id bigint, tie bigint, fp bigint")


def _masks(bits: list[int], blocks: int = 6) -> list[int]:
    """For each way to keep all but MOST_BITS of the blocks of the given bits, the bits kept."""
    cuts = [sum(1 << b for b in part) for part in np.array_split(np.array(bits, "O"), blocks)]
    return [sum(c) for c in combinations(cuts, blocks - MOST_BITS)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for n, m in enumerate(masks)])


def forest(fps: np.ndarray, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between distinct fingerprints, compared tile by tile."""
    n = len(fps)
    label = np.arange(n)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, n, TILE):
        for to in range(at, n, TILE):
            near = np.bitwise_count(fps[at:at + TILE, None] ^ fps[None, to:to + TILE]) <= most_bits
            i, j = np.nonzero(near)
            i, j = i + at, j + to
            apart = (i < j) & (label[i] != label[j])
            i, j = i[apart], j[apart]
            while len(i):   # each pass links every tree to its smallest neighbour
                a, b = np.maximum(label[i], label[j]), np.minimum(label[i], label[j])
                first = np.r_[True, np.diff(a[o := np.lexsort((b, a))]) > 0]
                pick = o[first]
                out.append((i[pick], j[pick]))
                parent = np.arange(n)
                parent[a[pick]] = b[pick]
                while (parent != (up := parent[parent])).any():
                    parent = up
                label = parent[label]
                still = label[i] != label[j]
                i, j = i[still], j[still]
    if not out:
        return fps[:0], fps[:0]
    return fps[np.concatenate([o[0] for o in out])], fps[np.concatenate([o[1] for o in out])]


def _link_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within equal keys; rows come sorted by their keys, with `fp` last."""
    held: list[np.ndarray] = []

    def groups(rows: np.ndarray, last: bool) -> Iterator[np.ndarray]:
        new = np.r_[True, (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(rows)]
        for s, e in zip(starts, ends):
            if e == len(rows) and not last:
                held.append(rows[s:])
            elif e - s > 1:
                yield rows[s:e, -1]

    def linked(rows: np.ndarray, last: bool) -> pa.RecordBatch:
        found = [forest(np.unique(g).view("u8")) for g in groups(rows, last)] if len(rows) else []
        a = np.concatenate([f[0] for f in found] or [np.zeros(0, "u8")])
        b = np.concatenate([f[1] for f in found] or [np.zeros(0, "u8")])
        return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], ["a", "b"])

    width = 0
    for batch in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("i8")
        width = rows.shape[1]
        rows = np.concatenate([*held, rows])
        held.clear()
        yield linked(rows, last=False)
    if held:
        yield linked(np.concatenate(held), last=True)


def links(prints: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """a, b: links that connect whatever links at MOST_BITS connect; `prints` has distinct fp."""
    masks = _masks(list(range(64)))
    keyed = prints.withColumn("k", F.explode(_keys(F.col("fp"), masks))).select("k.choice", "k.key", "fp")
    hot = (keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_key)
           .select("choice", "key", F.lit(True).alias("hot")))
    keyed = keyed.join(stored(hot, "hot-keys"), ["choice", "key"], "left")
    # a hot key's other bits, cut in turn; which bits these are depends on the choice
    inner = F.array(*[_keys(F.col("fp"), _masks([b for b in range(64) if not m >> b & 1])) for m in masks])
    none = F.array(F.struct(F.lit(-1).alias("choice"), F.lit(0).cast("bigint").alias("key")))
    keyed = keyed.withColumn("s", F.explode(F.when(F.col("hot"), F.get(inner, F.col("choice"))).otherwise(none)))
    keys = [F.col("choice").cast("bigint").alias("c1"), F.col("key").alias("k1"),
            F.col("s.choice").cast("bigint").alias("c2"), F.col("s.key").alias("k2"), "fp"]
    by = ["c1", "k1", "c2", "k2"]
    return (keyed.select(*keys).repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(releasing(_link_sorted), "a bigint, b bigint"))


def _parts(prints: DataFrame, hot_key: int) -> DataFrame:
    """print, part: for every fingerprint the smallest one of its component."""
    distinct = stored(prints.select("fp").distinct(), "distinct-fingerprints")
    parts = connected_components(links(distinct, hot_key), "fingerprint-links")
    return distinct.join(parts, distinct.fp == parts.node, "left").select(
        distinct.fp.alias("print"), F.coalesce("component", "fp").alias("part"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    hot_key: int = HOT_KEY) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of `docs`.

    Null and empty texts and those of white space have fingerprint 0 and link like others.
    Texts shorter than a shingle are one shingle. Repeated rows and ids count as rows;
    component_id is the smallest id of the component, null ids apart (null if there is no
    other). Whole texts are read, however long. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    by_print = stored(_parts(prints, hot_key).join(least, F.col("print") == F.col("fp")).select("print", "part", "least"), "parts")
    smallest = by_print.groupBy("part").agg(F.min("least").alias("component_id"))
    named = by_print.join(smallest, "part").select("print", "component_id")
    return (prints.join(named, prints.fp == named.print)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                hot_key: int = HOT_KEY) -> DataFrame:
    """The rows of `docs` that stay: one of each component, that of the smallest id (null ids last), then of the
    smallest text hash. Of repeated rows one stays. All columns of `docs`; the rest as for `near_duplicates`."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    in_order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tie")
    first = prints.groupBy("fp").agg(F.min(in_order).alias("first"))
    kept = (first.join(_parts(prints, hot_key), F.col("print") == F.col("fp"))
            .groupBy("part").agg(F.min("first").alias("first"))
            .select(F.xxhash64("first.doc_id", "first.tie").alias("k1"),
                    F.xxhash64("first.tie", F.lit(SEED), "first.doc_id").alias("k2")).distinct())
    tie = F.xxhash64(F.col(text_col).cast("string"))
    row_id = F.col(id_col).cast("bigint")
    keyed = docs.withColumns({"key of row 1": F.xxhash64(row_id, tie), "key of row 2": F.xxhash64(tie, F.lit(SEED), row_id)})
    one = Window.partitionBy("key of row 1", "key of row 2").orderBy(F.lit(0))
    return (keyed.join(kept, (F.col("key of row 1") == F.col("k1")) & (F.col("key of row 2") == F.col("k2")), "left_semi")
            .withColumn("place of row", F.row_number().over(one)).filter(F.col("place of row") == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
