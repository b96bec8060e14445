"""Anchored suffixes of texts: choice, order, front coding and merging.

A window is a string of WINDOW bytes within one text. Its anchor is the place of the smallest hash among the grams of GRAM
bytes in it, the leftmost of equals; equal windows have their anchor at the same place.
So windows are compared by their anchors' contexts: the suffix that begins at the anchor, up to WINDOW
bytes, and then what stands before it, backwards. Only about two in GRAM positions are anchors.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import zstandard

from clickweir.llm.quality_fm import _BACK, _ODD, _powers

WINDOW = 50
GRAM = 26
REACH = WINDOW - GRAM            # most bytes between a window's start and its anchor
CONTEXT = WINDOW + REACH         # bytes of a context


@dataclass
class Anchors:
    """Columns of the anchors of a piece of text, by place."""
    at: np.ndarray       # byte of the piece
    first: np.ndarray    # its windows start from here
    last: np.ndarray     # to here
    gram: np.ndarray     # hash of the gram


def anchors(data: np.ndarray, starts: np.ndarray) -> Anchors:
    n = len(data)
    none = np.zeros(0, "i8")
    if n < WINDOW or int(np.diff(starts).max(initial=0)) < WINDOW:
        return Anchors(none, none, none, none.astype("u8"))
    run = data.astype("u8")
    run += np.uint64(1)
    run *= _powers(_ODD, n)
    run = np.concatenate([np.zeros(1, "u8"), np.cumsum(run)])
    h = (run[GRAM:] - run[:-GRAM]) * _powers(_BACK, n)[:n - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (h & ~low) | np.arange(len(h), dtype="u8")     # by hash, then by place
    width = 1
    while 2 * width <= REACH + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = REACH + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & low).astype("i8")
    inside = np.zeros(n + 1, "i4")                          # whether a window that starts here ends in its text
    long = np.diff(starts) >= WINDOW
    np.add.at(inside, starts[:-1][long], 1)
    np.add.at(inside, starts[1:][long] - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:-1])[:len(place)] > 0)
    of = place[window]
    # windows of one anchor follow each other; an anchor lies in its window's text, so texts never share one
    new = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return Anchors(of[new], window[new], window[np.r_[new[1:], len(of)] - 1], h[of[new]])


def contexts(data: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows of CONTEXT bytes; what lies beyond the text (begin, end) is 0."""
    out = np.zeros((len(at), CONTEXT), "u1")
    padded = np.concatenate([np.zeros(REACH, "u1"), data, np.zeros(WINDOW, "u1")])
    for j in range(WINDOW):
        out[:, j] = np.where(at + j < end, padded[at + REACH + j], 0)
    for j in range(REACH):
        out[:, WINDOW + j] = np.where(at - 1 - j >= begin, padded[at + REACH - 1 - j], 0)
    return out


def context_order(rows: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """The order of the contexts, ties by the given columns."""
    wide = np.zeros((len(rows), -(-CONTEXT // 8) * 8), "u1")
    wide[:, :CONTEXT] = rows
    words = wide.view(">u8").astype("u8")
    return np.lexsort((*reversed(more), *(words[:, j] for j in range(words.shape[1] - 1, -1, -1))))


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Of each row with the one before; 0 for the first."""
    out = np.zeros(len(rows), "u1")
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), CONTEXT)
    return out


def squeeze(*columns: np.ndarray) -> bytes:
    """Integer columns of one length, bytes of equal weight together, compressed."""
    n = len(columns[0])
    parts = [np.array([n, *[c.dtype.itemsize for c in columns]], "<u4").tobytes()]
    for c in columns:
        parts.append(np.ascontiguousarray(c.view("u1").reshape(n, -1).T).tobytes() if n else b"")
    return len(columns).to_bytes(1, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueeze(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), "u1")
    head = 4 * (1 + data[0])
    n, *sizes = raw[:head].view("<u4").tolist()
    out, at = [], head
    for size, kind in zip(sizes, kinds):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).reshape(-1).view(kind))
        at += n * size
    return out


@dataclass
class Run:
    """Sorted contexts, front-coded, with a text's id, its row and the windows of each."""
    common: np.ndarray   # u1, bytes shared with the context before
    tails: bytes         # the other bytes of all
    doc: np.ndarray      # i8
    row: np.ndarray      # i4
    first: np.ndarray    # i4, of the windows, from the text's start
    before: np.ndarray   # u1, bytes from the first window to the anchor
    windows: np.ndarray  # u1, their number

    @classmethod
    def of(cls, rows: np.ndarray, *columns: np.ndarray) -> "Run":
        common = common_prefixes(rows)
        tails = rows[np.arange(CONTEXT)[None, :] >= common[:, None]].tobytes()
        return cls(common, tails, *columns)

    def to_bytes(self) -> bytes:
        head = squeeze(*(getattr(self, f.name) for f in fields(self) if f.name != "tails"))
        return len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(level=3).compress(self.tails)

    @classmethod
    def from_bytes(cls, data: bytes) -> "Run":
        n = int.from_bytes(data[:4], "little")
        common, *rest = unsqueeze(data[4:4 + n], "u1", "<i8", "<i4", "<i4", "u1", "u1")
        return cls(common, zstandard.ZstdDecompressor().decompress(data[4 + n:]), *rest)

    def strings(self) -> list[bytes]:
        out, last, at = [], b"", 0
        for c in self.common.tolist():
            last = last[:c] + self.tails[at:(at := at + CONTEXT - c)]
            out.append(last)
        return out


def _mismatch(a: bytes, b: bytes, known: int) -> int:
    """Bytes that a and b share, given that they share `known`."""
    x, y = a[known:], b[known:]
    if x == y:
        return CONTEXT
    return CONTEXT - (((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) >> 3)


def merge(runs: list[Run]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(run, place in it) in the order of all contexts, the contexts, and what each shares with the one before.

    A loser tree over the runs. Every player keeps how many bytes its head shares with the last
    winner. Of two players the one that shares more comes first, without a look at the
    strings; only if both share the same are they compared, from there on.
    """
    strings = [r.strings() for r in runs]
    commons = [r.common.tolist() for r in runs]
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    place = [0] * k
    head: list[bytes | None] = [strings[i][0] if i < len(runs) and strings[i] else None for i in range(k)]
    share = [0] * k
    loser = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then shares with the winner what `share` says."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        sa, sb = share[a], share[b]
        if sa != sb:
            return (a, b) if sa > sb else (b, a)
        common = _mismatch(x, y, sa)
        if common == CONTEXT or x[common] < y[common]:
            share[b] = common
            return a, b
        share[a] = common
        return b, a

    winners = list(range(k))            # build the tree from its leaves
    level = k
    while level > 1:
        level //= 2
        pairs = [play(winners[2 * i], winners[2 * i + 1]) for i in range(level)]
        for i, (w, lost) in enumerate(pairs):
            loser[level + i] = lost
        winners = [w for w, _ in pairs]
    winner = winners[0]
    out_run, out_place, out, out_share = [], [], [], []
    while (top := head[winner]) is not None:
        at = place[winner]
        out_run.append(winner)
        out_place.append(at)
        out.append(top)
        out_share.append(share[winner])
        at += 1
        place[winner] = at
        if at < len(strings[winner]):
            head[winner] = strings[winner][at]
            share[winner] = commons[winner][at]
        else:
            head[winner] = None
        node = (winner + k) >> 1
        while node:
            other = loser[node]
            y = head[other]
            if y is not None:
                sb = share[other]
                x = head[winner]
                if x is None:
                    loser[node], winner = winner, other
                else:
                    sa = share[winner]
                    if sb > sa:
                        loser[node], winner = winner, other
                    elif sa == sb:
                        common = _mismatch(x, y, sa)
                        if common == CONTEXT or x[common] < y[common]:
                            share[other] = common
                        else:
                            share[winner] = common
                            loser[node], winner = winner, other
            node >>= 1
    return np.array(out_run, "i4"), np.array(out_place, "i4"), out, np.array(out_share, "u1")
