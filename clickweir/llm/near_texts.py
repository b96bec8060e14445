"""SimHash near-dedup of texts, verified by their five-word shingles.

A text's words, each with the root of its count, give a few fingerprints by different hashes. Pigeonhole blocks find
fingerprints that differ in at most three bits, as in `simhash`: what comes out is a spanning forest per fingerprint, and a
star of the texts that share one. Every such pair of texts is verified: two are near copies if their sets of five-word
shingles are alike by 0.8 or more (Jaccard). Words are less disturbed by an edit than shingles are, so texts that alike
have a close fingerprint far more often than by fingerprints of the shingles themselves.

A pair of forest or star that is not alike may part texts that are alike by other pairs. So where one parts groups, every
close pair between the groups is looked at in turn, and verified unless bounds on its shingles rule it out. This is done
where the texts of a key meet, and what comes out is again a forest: neither a large group of near copies nor many close
texts that are not alike ever leave a task as pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickweir.llm.components import connected_components
from clickweir.llm.simhash import HOT_KEY, MOST_BITS, SEED, _keys, _masks, forest
from clickweir.llm.workers import releasing, ship_package
from clickweir.session import stored

SHINGLE = 5
SIMILARITY = 0.8
PRINTS = 6
BLOCKS = 5       # of a fingerprint; those of three bits apart agree in two of them, 10 keys of about 26 bits
CHOICES = _masks(list(range(64)), BLOCKS)
INNER = [_masks([b for b in range(64) if not m >> b & 1]) for m in CHOICES]      # of a choice's other bits, for hot keys
OPEN_TILE = 512      # texts of a key that are verified against as many others in one place
_MIX = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between white space of ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_prints(text: str | None, prints: int = PRINTS) -> np.ndarray:
    """Fingerprints of the words by their weights; all 0 without words."""
    from xxhash import xxh64_intdigest

    count = Counter(words(text))
    if not count:
        return np.zeros(prints, "u8")
    h = np.array([xxh64_intdigest(w, SEED) for w in count], "u8")
    weight = np.sqrt(np.array(list(count.values()), "f4"))
    out = np.empty(prints, "u8")
    for k in range(prints):
        mixed = h + np.uint64((k + 1) * _MIX % (1 << 64))
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        bits = np.unpackbits(mixed.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        out[k] = np.packbits(2 * (weight @ bits) > weight.sum(), bitorder="little").view("u8")[0]
    return out


def shingles(text: str | None, shingle: int = SHINGLE) -> set[bytes]:
    """Runs of so many words; the whole text if it has fewer."""
    w = words(text)
    return {b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))}


def _marks(batches: Iterable[pa.RecordBatch], prints: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = np.array([word_prints(t.as_py(), prints) for t in batch.column(3)], "u8").reshape(-1, prints).view("i8")
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(got[:, k]) for k in range(prints)]],
                                         ["doc_id", "t1", "t2", *[f"p{k}" for k in range(prints)]])


def _alike(batches: Iterable[pa.RecordBatch], shingle: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = shingles(x.as_py(), shingle), shingles(y.as_py(), shingle)
            both = len(a & b)
            keep.append(both >= similarity * (len(a) + len(b) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def sketch(text: str | None, shingle: int = SHINGLE) -> tuple[int, np.ndarray]:
    """The number of different shingles, and the parity of the shingles in each of 256 buckets. Sets that differ in d shingles
    have sketches that differ in d bits at most."""
    from xxhash import xxh64_intdigest

    found = shingles(text, shingle)
    buckets = np.array([xxh64_intdigest(s, SEED) & 255 for s in found], "i8")
    return len(found), np.packbits(np.bincount(buckets, minlength=256) & 1).view("i8")


def _sketches(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [sketch(t.as_py(), shingle) for t in batch.column("text")]
        bits = np.array([b for _, b in got], "i8").reshape(-1, 4)
        kept = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([n for n, _ in got], pa.int64()), *[pa.array(bits[:, k]) for k in range(4)]],
                                         [*kept.schema.names, "n", *[f"s{k}" for k in range(4)]])


def _hashes(text_col: str) -> list:
    """Two hashes that tell texts apart; null is a text of its own, and so is the empty one."""
    text = F.col(text_col).cast("string")
    return [F.xxhash64(text, F.lit(1)).alias("t1"), F.xxhash64(F.lit(SEED), text).alias("t2")]


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Rows of equal keys, the groups that end in a batch together; rows come sorted by the key, their first column."""
    held = None
    for batch in chain(batches, [None]):
        if batch is not None:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("i8")
            held = rows if held is None else np.concatenate([held, rows])
        if held is None or not len(held):
            continue
        starts = np.flatnonzero(np.r_[True, held[1:, 0] != held[:-1, 0]])
        ends = np.r_[starts[1:], len(held)]
        whole = len(starts) - (batch is not None)      # the last group may go on
        yield [held[s:e] for s, e in zip(starts[:whole], ends[:whole]) if e - s > 1]
        held = held[starts[whole]:] if whole < len(starts) else held[:0]


def _links_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    none = [np.zeros(0, "i8")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or none)), pa.array(np.concatenate(b or none))], ["a", "b"])


def _link_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of nodes within equal keys; rows of key, fp and node come sorted by their keys."""
    for groups in _groups(batches):
        a, b = [], []
        for rows in groups:
            fps, at = np.unique(rows[:, 1], return_index=True)
            node = rows[:, 2][at]
            x, y = forest(fps.view("u8"))
            a.append(node[np.searchsorted(fps, x.view("i8"))])
            b.append(node[np.searchsorted(fps, y.view("i8"))])
        yield _links_batch(a, b)


def _first_meeting(differ: np.ndarray, place: int) -> np.ndarray:
    """Whether pairs meet at no earlier place; `differ` has the differing bits of each fingerprint."""
    at, rest = divmod(place, len(INNER[0]) + 1)
    at, choice = divmod(at, len(CHOICES))
    first = (np.bitwise_count(differ[:, :at]) > MOST_BITS).all(axis=1)
    for mask in (*CHOICES[:choice], *INNER[choice][:max(0, rest - 1)]):
        first &= (differ[:, at] & np.uint64(mask)) != 0
    return first


def _may_be_alike(n: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """False for pairs that the sizes or sketches of their sets rule out."""
    most = (1 - similarity) / (1 + similarity) * (n[i] + n[j]) + 1e-6      # by so many may sets of that similarity differ
    return np.maximum(np.abs(n[i] - n[j]), np.bitwise_count(bits[i] ^ bits[j]).sum(axis=-1, dtype="i8")) <= most


def _open_sorted(batches: Iterable[pa.RecordBatch], similarity: float, tile: int = OPEN_TILE) -> Iterator[pa.RecordBatch]:
    """key, place, x, y, node of the texts to be verified with others of their key: those of close pairs of different labels that may be
    alike, where these first meet. Rows of key, place, node, label, n, sketch and fingerprints come sorted by their keys; a key of
    many texts is cut into tiles, of which x and y meet."""
    for rows in chain.from_iterable(_groups(batches)):
        if (rows[:, 3] == rows[0, 3]).all():
            continue
        for place in np.unique(rows[:, 1]):      # one, unless two keys have one hash
            here = rows[rows[:, 1] == place]
            here = here[np.argsort(here[:, 3], kind="stable")]
            node, label, n, bits, marks = here[:, 2], here[:, 3], here[:, 4], here[:, 5:9].view("u8"), here[:, 9:].view("u8")
            fps = marks[:, int(place) // (len(INNER[0]) + 1) // len(CHOICES)]
            for at in range(0, len(here), tile):
                for to in range(at, len(here), tile):
                    x, y = slice(at, at + tile), slice(to, to + tile)
                    if label[x][0] == label[y][-1]:
                        continue
                    i, j = np.nonzero((np.bitwise_count(fps[x, None] ^ fps[None, y]) <= MOST_BITS) & (label[x, None] != label[None, y]))
                    i, j = i + at, j + to
                    i, j = i[i < j], j[i < j]
                    may = _may_be_alike(n, bits, i, j, similarity)
                    i, j = i[may], j[may]
                    first = _first_meeting(marks[i] ^ marks[j], int(place))
                    if first.any():
                        found = node[np.unique(np.r_[i[first], j[first]])]
                        same = [pa.array(np.full(len(found), v, "i8")) for v in (here[0, 0], place, at, to)]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(found)], ["key", "place", "x", "y", "node"])


def _with_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[str | None]]]:
    """The rows of each key and their texts; rows come sorted by the key, their first column, and with the text last."""
    held, texts = None, []
    for batch in chain(batches, [None]):
        if batch is not None:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype("i8")
            held = rows if held is None else np.concatenate([held, rows])
            texts += batch.columns[-1].to_pylist()
        if held is None or not len(held):
            continue
        starts = np.flatnonzero(np.r_[True, held[1:, 0] != held[:-1, 0]])
        ends = np.r_[starts[1:], len(held)]
        whole = len(starts) - (batch is not None)      # the last group may go on
        for s, e in zip(starts[:whole], ends[:whole]):
            yield held[s:e], texts[s:e]
        cut = starts[whole] if whole < len(starts) else len(held)
        held, texts = held[cut:], texts[cut:]


def _hashed(text: str | None, shingle: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.unique(np.array([xxh64_intdigest(s, SEED) for s in shingles(text, shingle)], "u8"))


def _alike_sorted(batches: Iterable[pa.RecordBatch], shingle: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the close pairs that are alike, between different labels of a key. Rows of key, node, label, n,
    sketch, fingerprints and text come sorted by their keys. Hashes of shingles find the pairs, the shingles decide."""
    for rows, texts in _with_texts(batches):
        node, label, n, bits, marks = rows[:, 1], rows[:, 2].copy(), rows[:, 3], rows[:, 4:8].view("u8"), rows[:, 8:].view("u8")
        hashes: list[np.ndarray | None] = [None] * len(rows)
        a, b = [], []
        for i in range(len(rows) - 1):
            j = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
            j = j[(np.bitwise_count(marks[j] ^ marks[i]) <= MOST_BITS).any(axis=1)]
            for k in j[_may_be_alike(n, bits, np.full(len(j), i), j, similarity)]:
                if label[k] == label[i]:
                    continue
                for t in (i, k):
                    if hashes[t] is None:
                        hashes[t] = _hashed(texts[t], shingle)
                both = len(np.intersect1d(hashes[i], hashes[k], assume_unique=True))
                if both >= similarity * (n[i] + n[k] - both):
                    x, y = shingles(texts[i], shingle), shingles(texts[k], shingle)
                    both = len(x & y)
                    if both >= similarity * (len(x) + len(y) - both):
                        a.append(node[i])
                        b.append(node[k])
                        label[label == label[k]] = label[i]
            hashes[i] = None
        yield _links_batch([np.array(a, "i8")], [np.array(b, "i8")])


def _by_close_keys(rows: DataFrame, hot_key: int, count: int, *columns: str) -> DataFrame:
    """`columns` of `rows` once for each key of their print and fp, such that close fingerprints share one; sorted by `key`
    within tasks. `count` says about how many rows there are. `place` is a number for the print, the choice of blocks and
    that of the blocks within."""
    # one hash stands for print, choice and key; two keys of one hash are compared together, which links nothing more
    keyed = (rows.withColumn("k", F.explode(_keys(F.col("fp"), CHOICES)))
             .withColumn("key", F.xxhash64("print", "k.choice", "k.key")).withColumn("choice", F.col("k.choice")))
    # a hot key is in a crowded bucket of keys; only these count their keys one by one
    buckets = max(1 << 16, count * len(CHOICES) // 1024)
    bucket = F.pmod("key", F.lit(buckets))
    crowded = stored(keyed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).filter(F.col("n") > hot_key).select("bucket"), "crowded")
    hot = stored(keyed.join(crowded, bucket == F.col("bucket"), "left_semi").groupBy("key").agg(F.count("*").alias("n"))
                 .filter(F.col("n") > hot_key).select("key", F.lit(True).alias("hot")), "hot-keys")
    # a hot key's other bits, cut in turn; which bits these are depends on the choice
    inner = F.array(*[_keys(F.col("fp"), masks) for masks in INNER])
    parts = F.transform(F.get(inner, F.col("choice")), lambda s: F.struct(F.xxhash64("key", s["choice"], s["key"]).alias("key"), (s["choice"] + 1).alias("rest")))
    whole = F.array(F.struct("key", F.lit(0).alias("rest")))
    place = (F.col("print").cast("bigint") * len(CHOICES) + F.col("choice")) * (len(INNER[0]) + 1) + F.col("part.rest")
    dealt = keyed.join(hot, "key", "left").withColumn("part", F.explode(F.when(F.col("hot"), parts).otherwise(whole))) \
        .withColumn("place", place).select(F.col("part.key").alias("key"), *columns)
    return dealt.repartition("key").sortWithinPartitions("key")


def _prints(texts: DataFrame, prints: int, *columns: str) -> DataFrame:
    return texts.select("node", *columns, F.posexplode(F.array(*[f"p{k}" for k in range(prints)])).alias("print", "fp"))


def _candidates(texts: DataFrame, prints: int, hot_key: int) -> DataFrame:
    """Pairs of nodes: of every fingerprint the links between values, and of texts of one value with the first."""
    of = _prints(texts, prints)
    first = stored(of.groupBy("print", "fp").agg(F.min("node").alias("first")), "fingerprints")
    star = of.join(first, ["print", "fp"]).filter(F.col("node") > F.col("first")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    close = _by_close_keys(first, hot_key, first.count(), "fp", "first").mapInArrow(releasing(_link_sorted), "a bigint, b bigint")
    return star.unionAll(close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _verified(pairs: DataFrame, content: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs whose texts are alike."""
    both = pairs.join(content.select(F.col("node").alias("a"), F.col("text").alias("x")), "a") \
        .join(content.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(releasing(lambda b: _alike(b, shingle, similarity)), "a bigint, b bigint"), "near-copies")


def _groups_of_copies(texts: DataFrame, pairs: DataFrame, content: DataFrame, shingle: int, similarity: float, prints: int,
                      hot_key: int) -> DataFrame:
    """node, component of all texts with a near copy, as if every close pair had been verified.

    Verified `pairs` give groups. One that is not alike and lies between two groups leaves open whether other pairs link them;
    close texts of different groups are always joined by a chain of `pairs`, so the groups at such pairs are all that can be
    linked yet. Of these, the close pairs between groups are verified.
    """
    parts = stored(connected_components(_verified(pairs, content, shingle, similarity), "near-links"), "groups")
    label = stored(content.select("node").join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("label")), "group-labels")
    parted = stored(pairs.join(label.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
                    .join(label.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").filter("la <> lb"), "parted")
    ends = stored(parted.select(F.col("la").alias("label")).union(parted.select("lb")).distinct(), "open-groups")
    # the sketches of all texts in such groups
    marks = [f"p{k}" for k in range(prints)]
    members = texts.select("node", *marks).join(label.join(ends, "label"), "node").join(content, "node").select("node", "label", *marks, "text")
    kinds = ", ".join(f"{c} bigint" for c in ("node", "label", *marks, "n", "s0", "s1", "s2", "s3"))
    open_texts = stored(members.mapInArrow(releasing(lambda b: _sketches(b, shingle)), kinds), "open-texts")
    judged = ("n", "s0", "s1", "s2", "s3", *marks)
    rows = _by_close_keys(_prints(open_texts, prints, "label", *judged), hot_key, prints * open_texts.count(), "place", "node", "label", *judged)
    meeting = stored(rows.mapInArrow(releasing(lambda b: _open_sorted(b, similarity)), "key bigint, place bigint, x bigint, y bigint, node bigint"), "open-keys")
    more = meeting.join(open_texts, "node").join(content, "node") \
        .select(F.xxhash64("key", "place", "x", "y").alias("key"), "node", "label", *judged, "text").repartition("key").sortWithinPartitions("key") \
        .mapInArrow(releasing(lambda b: _alike_sorted(b, shingle, similarity)), "a bigint, b bigint")
    return connected_components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "group-links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY,
                prints: int = PRINTS, hot_key: int = HOT_KEY) -> DataFrame:
    """The rows of `docs` that stay: one of each group of near copies, that of the smallest id (null ids last). Of
    repeated rows one stays. All columns of `docs`.

    Null texts are copies of each other, and so are empty ones; a text without words is a near copy of every
    other such text, null ones among them. Whole texts are read, however long. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    row_id = F.col(id_col).cast("bigint")
    kinds = "doc_id bigint, t1 bigint, t2 bigint, " + ", ".join(f"p{k} bigint" for k in range(prints))
    marks = stored(docs.select(row_id.alias("doc_id"), *_hashes(text_col), F.col(text_col).cast("string"))
                   .mapInArrow(releasing(lambda b: _marks(b, prints)), kinds), "text-marks")
    in_order = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id")).alias("first")
    texts = stored(marks.groupBy("t1", "t2").agg(in_order, *[F.first(f"p{k}").alias(f"p{k}") for k in range(prints)])
                   .withColumn("node", F.monotonically_increasing_id()), "texts")
    pairs = stored(_candidates(texts, prints, hot_key), "candidates")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = texts.join(ends, "node").select("node", "t1", "t2")
    content = stored(docs.select(*_hashes(text_col), F.col(text_col).cast("string").alias("text")).join(wanted, ["t1", "t2"])
                     .groupBy("node").agg(F.first("text").alias("text")), "candidate-texts")
    parts = _groups_of_copies(texts, pairs, content, shingle, similarity, prints, hot_key).withColumnRenamed("node", "linked")
    kept = (texts.join(parts, F.col("node") == F.col("linked"), "left").groupBy(F.coalesce("component", "node").alias("part"))
            .agg(F.min(F.struct("first", "t1", "t2")).alias("k"))
            .select(F.col("k.first.doc_id").alias("k_id"), F.col("k.t1").alias("k1"), F.col("k.t2").alias("k2")))
    t1, t2 = _hashes(text_col)
    keyed = docs.withColumns({"key of row 1": t1, "key of row 2": t2, "id of row": row_id})
    one = Window.partitionBy("key of row 1", "key of row 2").orderBy(F.lit(0))
    return (keyed.join(kept, (F.col("key of row 1") == F.col("k1")) & (F.col("key of row 2") == F.col("k2"))
                       & F.col("id of row").eqNullSafe(F.col("k_id")), "left_semi")
            .withColumn("place of row", F.row_number().over(one)).filter(F.col("place of row") == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
