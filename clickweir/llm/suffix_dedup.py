"""Exact removal of repeated byte strings by a distributed sort of anchored suffixes.

Texts are dealt to buckets of a few MB by a hash; the dealt texts are shuffled once and read three times.

1. Each bucket sends the fingerprints of its anchors' grams, sorted and delta-coded, to ranges of
   fingerprints; back come those that occur in two texts or more. This is the first round of
   prefix doubling: all other suffixes are told apart by their first GRAM bytes.
2. Each bucket sorts the contexts of the anchors that are left, keeps of equal ones those of the
   smallest id, and sends them as front-coded runs to the ranges. A range merges its runs by a
   loser tree that hands the common prefixes on. From these prefixes follow the groups of equal
   windows, and in each the smallest id. Grams of very many texts are not sent as contexts but window
   by window, by the windows' hashes, so that no range has to hold them all.
3. Each bucket removes the bytes of the windows that a smaller id has.

Exact copies of a text with a smaller id are found by a hash beforehand; they are removed whole and
take no part in the sort.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickweir.llm.quality_fm import _powers
from clickweir.llm.suffix_runs import CONTEXT, REACH, WINDOW, Anchors, Run, anchors, context_order, contexts, merge, squeeze, unsqueeze
from clickweir.llm.utf8 import pieces
from clickweir.llm.workers import frees
from clickweir.operators.joins import BROADCAST_BYTES, estimated_bytes
from clickweir.session import stored

BUCKET_BYTES = 4 << 20
MOST_BUCKETS = 8192          # beyond that, buckets grow up to LARGE_BUCKET
LARGE_BUCKET = 64 << 20
SALTS = 16                   # tasks that the copies of one text go to
HOT_GRAM = 2000              # texts of a gram that are still compared by contexts
PRINT_BITS = 40              # of a fingerprint; more where there are more anchors
NO_ID = (1 << 63) - 1        # stands for a null id, larger than all

SIDE = "bucket bigint, kind int, id bigint, sha binary, data binary"
COPY, ALIVE, REMOVED = 0, 1, 2           # kinds of what comes back to a bucket
CONTEXTS, WINDOWS, LOCAL = 0, 1, 2       # kinds of what a bucket sends

_SECOND = 0xD6E8FEB86659FD93             # an odd multiplier, for a second hash of windows
_SECOND_BACK = pow(_SECOND, -1, 1 << 64)


class _Bucket:
    """The texts of a bucket in the order of their ids, those that are whole copies marked."""

    def __init__(self, table: pa.Table, side: pa.Table):
        ids, shas = table.column("id").to_numpy(), table.column("sha").to_pylist()
        order = sorted(range(table.num_rows), key=lambda i: (ids[i], shas[i]))
        self.table = table.take(pa.array(order, pa.int64())).combine_chunks()
        self.ids = ids[order]
        kinds = side.column("kind").to_pylist()
        copies = {(i, s) for k, i, s in zip(kinds, side.column("id").to_pylist(), side.column("sha").to_pylist()) if k == COPY}
        self.copy = np.array([(ids[i], shas[i]) in copies for i in order], bool)
        self.data = [d for k, d in zip(kinds, side.column("data").to_pylist()) if k != COPY]

    def pieces(self):
        """(number of the first text, bytes, starts) of all texts."""
        for chunk in self.table.column("text").chunks:
            for rows, data, starts in pieces(chunk):
                yield rows.start, data, starts

    def anchored(self):
        """(first text, bytes, starts, anchors, text of each) without whole copies."""
        for row, data, starts in self.pieces():
            a = anchors(data, starts)
            text = np.searchsorted(starts, a.at, "right") - 1
            own = ~self.copy[row + text]
            yield row, data, starts, Anchors(a.at[own], a.first[own], a.last[own], a.gram[own]), text[own]


def _range_of(prints: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    return ((prints >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)


def _joined(columns: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*columns)]


def _ranges(ranges: np.ndarray):
    """(range, from, to) of ascending range numbers."""
    starts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]]) if len(ranges) else []
    for s, e in zip(starts, [*starts[1:], len(ranges)]):
        yield int(ranges[s]), s, e


def _send_prints(bucket: _Bucket, bits: int, ranges: int):
    found = [(a.gram >> np.uint64(64 - bits), (row + text).astype("i4")) for row, _, _, a, text in bucket.anchored()]
    if not found:
        return
    prints, row = _joined(found)
    doc = bucket.ids[row]
    order = np.lexsort((doc, prints))
    prints, doc = prints[order], doc[order]
    new = np.r_[True, prints[1:] != prints[:-1]]
    texts = np.r_[True, new[1:] | (doc[1:] != doc[:-1])]
    starts = np.flatnonzero(new)
    count = np.minimum(np.add.reduceat(texts.astype("i8"), starts), 65535).astype("<u2") if len(starts) else np.zeros(0, "<u2")
    prints = prints[starts]
    for part, s, e in _ranges(_range_of(prints, bits, ranges)):
        yield part, squeeze(_deltas(prints[s:e]), count[s:e])


def _deltas(sorted_: np.ndarray) -> np.ndarray:
    d = np.diff(sorted_, prepend=np.uint64(0))
    return d.astype("<u8")


def _find_alive(table: pa.Table):
    """For each bucket its fingerprints that two texts have, with whether very many do."""
    buckets = table.column("bucket").to_numpy()
    runs = [unsqueeze(d, "<u8", "<u2") for d in table.column("data").to_pylist()]
    if not runs:
        return
    prints = np.concatenate([np.cumsum(r[0]) for r in runs])
    texts = np.concatenate([r[1] for r in runs]).astype("i8")
    of = np.repeat(np.arange(len(runs)), [len(r[0]) for r in runs])
    order = np.argsort(prints, kind="stable")
    new = np.r_[True, np.diff(prints[order]) > 0]
    group = np.cumsum(new) - 1
    total = np.bincount(group, texts[order])
    alive, hot = np.empty(len(order), bool), np.empty(len(order), bool)
    alive[order], hot[order] = total[group] > 1, total[group] > HOT_GRAM
    for n, bucket in enumerate(buckets.tolist()):
        mine = alive & (of == n)
        if mine.any():
            yield bucket, squeeze(_deltas(prints[mine]), hot[mine].view("u1"))


def _window_hashes(data: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base, back in ((_SECOND, _SECOND_BACK), (_SECOND ^ 0x55AA00, pow(_SECOND ^ 0x55AA00, -1, 1 << 64))):
        run = (data.astype("u8") + np.uint64(1)) * _powers(base, len(data))
        run = np.concatenate([np.zeros(1, "u8"), np.cumsum(run)])
        h = (run[p + WINDOW] - run[p]) * _powers(back, len(data))[p]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        out.append(h ^ (h >> np.uint64(32)))
    return out[0], out[1]


def _leaders(same: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of sorted rows, where `same` says that a row equals the one before: those of the group's first id."""
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    return doc == doc[start]


def _send_contexts(bucket: _Bucket, bits: int, ranges: int):
    """(kind, range, data): runs of contexts, windows of hot grams, and what the bucket itself removes."""
    runs = [unsqueeze(d, "<u8", "u1") for d in bucket.data]
    if not runs:
        return
    prints, hot = np.concatenate([np.cumsum(r[0]) for r in runs]), np.concatenate([r[1] for r in runs])
    order = np.argsort(prints)
    prints, hot = prints[order], hot[order].astype(bool)
    rows, windows = [], []
    for row, data, starts, a, text in bucket.anchored():
        key = a.gram >> np.uint64(64 - bits)
        at = np.minimum(np.searchsorted(prints, key), len(prints) - 1)
        alive = prints[at] == key
        begin, end = starts[text], starts[text + 1]
        some = alive & ~hot[at]
        if some.any():
            place, first, last = a.at[some], a.first[some], a.last[some]
            # a context reaches as far as its windows do
            c = contexts(data, place, np.maximum(begin[some], first), np.minimum(end[some], last + WINDOW))
            rows.append((c, key[some], (row + text[some]).astype("<i4"), (first - begin[some]).astype("<i4"),
                         (place - first).astype("u1"), (last - first + 1).astype("u1")))
        many = np.flatnonzero(alive & hot[at])
        if len(many):
            n = a.last[many] - a.first[many] + 1
            p = np.repeat(a.first[many] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            own = np.repeat(text[many], n)
            windows.append((*_window_hashes(data, p), (row + own).astype("<i4"), (p - starts[own]).astype("<i4")))
    local = []
    if rows:
        c, key, row, first, before, number = _joined(rows)
        doc = bucket.ids[row].astype("<i8")
        order = context_order(c, before, number, doc, row)
        c, key, row, first, before, number, doc = (x[order] for x in (c, key, row, first, before, number, doc))
        same = np.r_[False, (c[1:] == c[:-1]).all(axis=1) & (before[1:] == before[:-1]) & (number[1:] == number[:-1])]
        lead = _leaders(same, doc)
        local.append((row[~lead], first[~lead], (first + number - 1)[~lead].astype("<i4")))
        part = _range_of(key[lead], bits, ranges)
        by_part = np.flatnonzero(lead)[np.argsort(part, kind="stable")]
        for n, s, e in _ranges(np.sort(part)):
            i = by_part[s:e]
            yield CONTEXTS, n, Run.of(c[i], doc[i], row[i], first[i], before[i], number[i]).to_bytes()
    if windows:
        h, h2, row, p = _joined(windows)
        doc = bucket.ids[row].astype("<i8")
        order = np.lexsort((row, doc, h2, h))
        h, h2, row, p, doc = (x[order] for x in (h, h2, row, p, doc))
        same = np.r_[False, (h[1:] == h[:-1]) & (h2[1:] == h2[:-1])]
        lead = _leaders(same, doc)
        local.append((row[~lead], p[~lead], p[~lead]))
        h, h2, row, p, doc = (x[lead] for x in (h, h2, row, p, doc))
        for n, s, e in _ranges(_range_of(h, 64, ranges)):
            yield WINDOWS, n, squeeze(h[s:e], h2[s:e], doc[s:e], row[s:e], p[s:e])
    if local:
        yield LOCAL, -1, squeeze(*_joined(local))


def _same_windows(key: np.ndarray, group: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (group, left side) stand together, and where each such run begins. `left` has the bytes
    as words; `key` is a hash of both, which decides unless two that differ share it."""
    order = np.argsort(key, kind="stable")
    new = np.r_[True, np.diff(key[order]) != 0]
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    if (group[order] != group[lead]).any() or (left[order] != left[lead]).any():
        order = np.lexsort((*left.T, group))
        new = np.r_[True, (np.diff(group[order]) != 0) | (left[order][1:] != left[order][:-1]).any(axis=1)]
    return order, new


def _removed_windows(runs: list[Run], mix: int = 0xBF58476D1CE4E5B9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, row, window start) of the windows that a smaller id has, from merged contexts. `mix` spreads the hashes of left sides."""
    of, place, strings, share = merge(runs)
    flat = np.concatenate([[0], np.cumsum([len(r.doc) for r in runs])])[of] + place
    doc, row, first, before, number = (np.concatenate([getattr(r, f) for r in runs])[flat]
                                       for f in ("doc", "row", "first", "before", "windows"))
    sides = np.frombuffer(b"".join(strings), "u1").reshape(-1, CONTEXT)[:, WINDOW:]
    back = sides.astype("u8") + np.uint64(1)
    padded = np.zeros((len(sides), -(-sides.shape[1] // 8) * 8), "u1")
    padded[:, :sides.shape[1]] = sides
    side_words = padded.view("<u8")
    left = np.zeros(len(doc), "u8")        # hash of the bytes before the anchor, as far as `o`
    before, number = before.astype("i8"), number.astype("i8")
    out = []
    for o in range(REACH + 1):
        # equal suffixes of WINDOW - o bytes stand together, equal left sides within them have equal hashes
        group = np.cumsum(share < WINDOW - o).astype("u8")
        some = np.flatnonzero((before >= o) & (before - number < o))
        if len(some):
            key = (group[some] * np.uint64(0x9E3779B97F4A7C15)) ^ left[some]
            mask = np.zeros(padded.shape[1], "u1")
            mask[:o] = 255
            order, new = _same_windows(key, group[some], side_words[some] & mask.view("<u8"))
            least = np.minimum.reduceat(doc[some][order], np.flatnonzero(new))[np.cumsum(new) - 1]
            late = some[order][doc[some][order] > least]
            out.append((of[late], row[late], (first + before - o)[late].astype("i4")))
        if o < REACH:
            left = left * np.uint64(mix) + back[:, o]
            left ^= left >> np.uint64(29)
    return tuple(_joined(out)) if out else (np.zeros(0, "i4"),) * 3


def _decide(table: pa.Table):
    """(bucket, rows and windows to remove) of a range."""
    kinds, buckets, data = (table.column(c).to_pylist() for c in ("kind", "bucket", "data"))
    pairs = list(zip(kinds, buckets, data))
    yield from ((b, d) for k, b, d in pairs if k == LOCAL)
    found = []
    runs = [(b, Run.from_bytes(d)) for k, b, d in pairs if k == CONTEXTS]
    if runs:
        of, row, p = _removed_windows([r for _, r in runs])
        found.append((np.array([b for b, _ in runs])[of], row, p))
    hot = [(b, unsqueeze(d, "<u8", "<u8", "<i8", "<i4", "<i4")) for k, b, d in pairs if k == WINDOWS]
    if hot:
        h, h2, doc, row, p = (np.concatenate([x[i] for _, x in hot]) for i in range(5))
        bucket = np.repeat([b for b, _ in hot], [len(x[0]) for _, x in hot])
        order = np.lexsort((doc, h2, h))
        new = np.r_[True, (h[order][1:] != h[order][:-1]) | (h2[order][1:] != h2[order][:-1])]
        least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        late = order[doc[order] > least]
        found.append((bucket[late], row[late], p[late]))
    if found:
        bucket, row, p = _joined(found)
        order = np.lexsort((p, row, bucket))
        bucket, row, p = bucket[order], row[order].astype("<i4"), p[order].astype("<i4")
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1]) | (p[1:] > p[:-1] + 1)][:len(p)]
        s = np.flatnonzero(new)
        e = np.r_[s[1:], len(p)] - 1
        for b, i, j in _ranges(bucket[s]):
            yield b, squeeze(row[s[i:j]], p[s[i:j]], p[e[i:j]])


def _remove(bucket: _Bucket, with_text: bool) -> dict[str, list]:
    parts = [unsqueeze(d, "<i4", "<i4", "<i4") for d in bucket.data]
    row, first, last = _joined(parts) if parts else (np.zeros(0, "i4"),) * 3
    order = np.argsort(row, kind="stable")
    row, first, last = row[order], first[order].astype("i8"), last[order].astype("i8")
    out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for number, data, starts in bucket.pieces():
        n = len(starts) - 1
        s, e = np.searchsorted(row, [number, number + n])
        change = np.zeros(len(data) + 1, "i4")
        base = starts[row[s:e] - number]
        np.add.at(change, base + first[s:e], 1)
        np.add.at(change, base + last[s:e] + WINDOW, -1)
        whole = bucket.copy[number:number + n] & (np.diff(starts) >= WINDOW)
        np.add.at(change, starts[:-1][whole], 1)
        np.add.at(change, starts[1:][whole], -1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        edge = starts[:-1][np.diff(starts) > 0]
        opens[edge] = gone[edge]
        spans = np.concatenate([[0], np.cumsum(opens)])
        raw = data.tobytes()
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            lost = int(removed[b] - removed[a])
            kept = data[a:b][~gone[a:b]].tobytes() if lost else raw[a:b]
            out["n_bytes"].append(b - a)
            out["n_removed"].append(lost)
            out["n_spans"].append(int(spans[b] - spans[a]))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept.decode("utf-8", "ignore") if lost else None)
    return out


def _rows(found, **kinds) -> pa.Table:
    found = list(found)
    return pa.table({name: pa.array([f[i] for f in found], kind) for i, (name, kind) in enumerate(kinds.items())})


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """Rows of repeated texts with the least id of their text. The texts are broadcast if they are few; else the copies of one
    text are dealt to SALTS tasks, each of which gets the text."""
    if estimated_bytes(least) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(least), F.col("sha") == F.col("c_sha"))
    salted = least.withColumn("c_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")) \
        .join(salted, (F.col("sha") == F.col("c_sha")) & (F.col("salt") == F.col("c_salt")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   keep: tuple[str, ...] = (), bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of `docs`.

    Every byte of a text's UTF-8 goes that lies in a 50-byte string which also starts in a text of
    a smaller id. Null texts count as empty; texts under 50 bytes lose nothing. A null id is larger
    than all others and equal to other null ids. Rows of the same id take nothing from each other. Texts may be of any length.
    An empty table gives no rows. With `with_text` there are also the columns in `keep` and `kept`, the
    remaining text, in which characters that lost a byte are dropped; null stays null.
    """
    text = F.col(text_col).cast("string")
    dealt = docs.select(
        F.col(id_col).cast("bigint").alias("given id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32)).alias("sha"), text.alias("text"),
        *[F.col(k).alias(f"kept {k}") for k in keep])
    marks = stored(dealt.select("id", "sha", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n")), "text-marks")
    total = marks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, min(-(-total // bucket_bytes), max(MOST_BUCKETS, -(-total // LARGE_BUCKET))))
    ranges = 2 * buckets
    bits = min(64, max(PRINT_BITS, total.bit_length() + 10))
    bucket = F.pmod(F.xxhash64("id", "sha"), F.lit(buckets)).alias("bucket")
    dealt = dealt.select("*", bucket)
    least = stored(marks.groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1")
                   .select(F.col("sha").alias("c_sha"), "least"), "repeated-texts")
    copies = _with_least(marks.select("id", "sha"), least).filter("id > least").select("id", "sha", bucket).distinct()
    none = F.lit(None).cast("binary")
    copies = stored(copies.select("bucket", F.lit(COPY).alias("kind"), "id", "sha", none.alias("data")), "whole-copies")

    def cogrouped(side: DataFrame, fn, schema: str) -> DataFrame:
        return dealt.groupBy("bucket").cogroup(side.groupBy("bucket")).applyInArrow(fn, schema)

    def back(df: DataFrame, kind: int) -> DataFrame:
        return copies.union(df.select("bucket", F.lit(kind), F.lit(None).cast("bigint"), none, "data"))

    @frees
    def send_prints(key, left, right):
        found = _send_prints(_Bucket(left, right), bits, ranges)
        return _rows(((p, key[0].as_py(), d) for p, d in found), part=pa.int64(), bucket=pa.int64(), data=pa.binary())

    @frees
    def find_alive(key, table):
        return _rows(_find_alive(table), bucket=pa.int64(), data=pa.binary())

    @frees
    def send_contexts(key, left, right):
        own = key[0].as_py()
        found = _send_contexts(_Bucket(left, right), bits, ranges)
        return _rows(((own if k == LOCAL else p, own, k, d) for k, p, d in found),
                     part=pa.int64(), bucket=pa.int64(), kind=pa.int32(), data=pa.binary())

    @frees
    def decide(key, table):
        return _rows(_decide(table), bucket=pa.int64(), data=pa.binary())

    @frees
    def remove(key, left, right):
        b = _Bucket(left, right)
        out = _remove(b, with_text)
        made = {"doc_id": b.table.column("given id"), "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()),
                "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if with_text:
            made |= {k: b.table.column(f"kept {k}") for k in keep}
            texts = b.table.column("text").to_pylist()
            made["kept"] = pa.array([t if k is None else k for t, k in zip(texts, out["kept"])], pa.string())
        return pa.table(made)

    sent = cogrouped(copies, send_prints, "part bigint, bucket bigint, data binary")
    alive = sent.groupBy("part").applyInArrow(find_alive, "bucket bigint, data binary")
    runs = cogrouped(back(alive, ALIVE), send_contexts, "part bigint, bucket bigint, kind int, data binary")
    gone = runs.groupBy("part").applyInArrow(decide, "bucket bigint, data binary")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += "".join(f", `{k}` {kinds[k]}" for k in keep) + ", kept string"
    return cogrouped(back(gone, REMOVED), remove, schema)
