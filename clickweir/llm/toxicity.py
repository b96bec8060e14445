"""Toxicity of texts after undoing obfuscation by a noisy channel.

A character language model of order four is counted over all texts. Stretches that a channel
of leetspeak, spacing and repetition may have made (letters beside signs and digits, doubled
letters, runs of single letters and signs, words with a blank that the language model would leave out) become
lattices: each sign is a letter it looks like, a boundary or nothing, and each repetition a shorter one. The Viterbi path under language model
and channel costs restores the text; everything else has one path, itself. The restored text is scored by
the strongest evidence of its words and their beginnings: the lower confidence bound of the
share of toxic texts among the labelled ones that have it, calibrated by logistic regression.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickweir.llm.quality_fm import running_hash, stretch_hashes, words
from clickweir.llm.utf8 import LOWER, pieces
from clickweir.llm.workers import releasing
from clickweir.session import stored

LEARNED_ROWS = 6000     # labelled texts that are learned from: those of the smallest id hashes
PREFIXES = (3, 4, 5, 6, 7, 8)  # bytes of the word beginnings that are evidence
CONFIDENCE = 1.645
CACHED = 200_000        # stretches whose restoration a Python worker remembers, for speed alone
PIECE = 1 << 18         # bytes of text that are scored together
REMEMBERED = 64         # characters of a stretch that is remembered; longer ones hardly come again
SETTLE_STEPS = 512      # steps of a Viterbi path after which its settled beginning is given out

# What signs may stand for, as is common in leetspeak; fixed values.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou"}
# Channel costs in nats: a sign as a letter, as nothing or a boundary, the same for signs that look like
# no letter, two equal letters for one, and a boundary at a space between single letters.
AS_LETTER, AS_NOTHING, AS_BOUNDARY = 1.0, 9.0, 4.0
MARK_AS_NOTHING, MARK_AS_BOUNDARY = 1.0, 0.5
SHORTENED, NOT_SPLIT = 6.0, 2.0
JOINED = 6.0            # a blank between longer pieces of a word as nothing
MARK_AT_END = 0.5       # an exclamation mark at the end of a word as what it mostly is, a boundary
SURE = 0.9              # bound from which a word is evidence whatever stands beside it
EVIDENCE = 0.5          # least bound of a word, or beginning, that counts as evidence

# Symbols of the language model: 0 no letter, 1-26 a-z, 27-31 other letters by their last byte
_SYMBOL = np.zeros(256, "u1")
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:192] = 27 + np.arange(64) % 5
_LEAD = np.zeros(256, bool)
_LEAD[192:] = True      # the rest of the character says which it is
_LETTER = (_SYMBOL > 0) | _LEAD
_LEET_BYTE = np.zeros(256, bool)
_LEET_BYTE[[ord(c) for c in LEET if c < "\x80"]] = True
_TWICE = np.uint64(0x5DEECE66D1234567)   # marks that two different words of a text have the evidence
_RUNS = re.compile(r"(.)\1*", re.S)


def gram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all runs of four symbols, over all rows of the one column of `texts`."""
    def run(batches):
        total = np.zeros(1 << 20, "i8")
        for batch in batches:
            for _, data, starts in pieces(batch.column(0)):
                keep = ~_LEAD[data]
                s = _SYMBOL[data]
                s[starts[:-1][np.diff(starts) > 0]] *= keep[starts[:-1][np.diff(starts) > 0]]
                s = s[keep].astype("i4")
                if len(s):
                    s = np.concatenate([np.zeros(3, "i4"), s, np.zeros(1, "i4")])
                    total += np.bincount((s[:-3] << 15) | (s[1:-2] << 10) | (s[2:-1] << 5) | s[3:], minlength=1 << 20)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    got = (texts.mapInArrow(releasing(run), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(1 << 20, "i8")       # 32**4 at most
    out[got["gram"].to_numpy()] = got["n"].to_numpy()
    return out


def log_probabilities(grams: np.ndarray) -> np.ndarray:
    """ln P(symbol | three before), interpolated down to uniform."""
    c4 = grams.reshape(32, 32, 32, 32).astype("f8")
    p = np.full(32, 1 / 32)
    for c in (c4.sum(axis=(0, 1, 2)), c4.sum(axis=(0, 1)), c4.sum(axis=0), c4):
        n = c.sum(axis=-1, keepdims=True)
        seen = (c > 0).sum(axis=-1, keepdims=True) + 1.0
        p = (c + seen * p) / (n + seen)     # Witten-Bell
    return np.log(p).ravel().astype("f4")


def _unrolled(path: tuple | None) -> list[tuple]:
    nodes = []
    while path:
        nodes.append(path)
        path = path[0]
    return nodes[::-1]


def _path(parts: list[str]) -> tuple | None:
    path = None
    for part in parts:
        path = (path, part)
    return path


def _undecorated(stretch: str) -> str:
    """Without three or more equal marks at the end."""
    bare = stretch.rstrip(stretch[-1:]) if stretch[-1:] and not (stretch[-1].isalnum() or stretch[-1] == "_") else stretch
    return bare if len(stretch) - len(bare) > 2 else stretch


class Restorer:
    def __init__(self, log_p: np.ndarray):
        self.log_p = array("f", log_p.tobytes())
        self.known: dict[str, str] = {}

    @staticmethod
    def _symbol(c: str) -> int:
        return int(_SYMBOL[c.encode("utf-8", "replace")[-1]]) if c.isalpha() else 0

    def _arcs(self, stretch: str):
        """For each run of equal characters the ways it may have come about, with their costs."""
        spaced = not any(len(w) > 1 for w in stretch.split())
        last = len(stretch)
        for found in _RUNS.finditer(stretch):
            c, n = found[1], len(found[0])
            if c.isspace():
                if n > 1:
                    yield [(" ", 0.0)]
                else:
                    yield [("", 0.0), (" ", NOT_SPLIT)] if spaced else [(" ", 0.0), ("", JOINED)]
            elif c.isalpha():
                if n == 1:
                    yield [(c, 0.0)]
                else:   # three or more are hardly meant, two may be
                    yield [(c * 2, 0.0 if n == 2 else 1.0), (c, SHORTENED if n == 2 else 1.0)]
            else:
                looks = LEET.get(c, "")
                yield [*((letter * k, AS_LETTER * k) for letter in looks for k in {1, min(n, 2)}),
                       ("", AS_NOTHING if looks else MARK_AS_NOTHING),
                       (" ", MARK_AT_END if c == "!" and found.end() == last else AS_BOUNDARY if looks else MARK_AS_BOUNDARY)]

    def decode(self, stretch: str) -> str:
        """The Viterbi path of the whole stretch; states are the last three symbols. What all survivors
        share is given out on the way, so that long stretches hold short paths."""
        log_p = self.log_p
        best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        settled: list[str] = []
        steps_held, most = 0, SETTLE_STEPS
        for ways in chain(self._arcs(stretch), [[(" ", 0.0)]]):
            steps_held += 1
            if steps_held > most:
                paths = [_unrolled(path) for _, path in best.values()]
                same = next((i for i, nodes in enumerate(zip(*paths)) if any(x is not nodes[0] for x in nodes)), len(paths[0]))
                settled += [part for _, part in paths[0][:same]]
                best = {state: (score, _path([part for _, part in nodes[same:]]))
                        for (state, (score, _)), nodes in zip(best.items(), paths)}
                steps_held -= same
                most = max(SETTLE_STEPS, 2 * steps_held)
            steps = [(out, cost, [self._symbol(c) for c in out]) for out, cost in ways]
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, path) in best.items():
                for out, cost, symbols in steps:
                    to, total = state, score - cost
                    for s in symbols:
                        if s == 0 and to & 31 == 0:
                            continue      # one boundary is enough
                        total += log_p[(to << 5) | s]
                        to = ((to << 5) | s) & 0x7FFF
                    if to not in after or total > after[to][0]:
                        after[to] = (total, (path, out))
            best = after
        path = max(best.values(), key=lambda x: x[0])[1]
        return "".join([*settled, *(part for _, part in _unrolled(path))]).strip()

    def _restored(self, stretch: str) -> str:
        low = stretch.lower()
        found = self.decode(_undecorated(low))
        return stretch if found == low.strip(punctuation) else found     # what the channel didn't make stays as it is

    def __call__(self, stretch: str) -> str:
        if len(stretch) > REMEMBERED:
            return self._restored(stretch)
        if stretch not in self.known:
            if len(self.known) > CACHED:
                self.known = {}
            self.known[stretch] = self._restored(stretch)
        return self.known[stretch]


def _blanks_left_out(data: np.ndarray, inner: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Where there is a blank between two letters of a text without which the language model finds the next three symbols
    likelier by JOINED or more. `inner` says which bytes are not the first of a text."""
    kept = np.flatnonzero(~_LEAD[data])    # as the model was counted
    bytes_, text = data[kept], np.cumsum(~inner)[kept]
    symbol = _SYMBOL[bytes_].astype("i4")
    at = np.flatnonzero((bytes_[1:-1] == 32) & (symbol[:-2] > 0) & (symbol[2:] > 0) & (text[:-2] == text[2:])) + 1
    symbol = np.concatenate([np.zeros(3, "i4"), symbol, np.zeros(3, "i4")])
    text = np.concatenate([np.zeros(3, "i8"), text, np.zeros(3, "i8")])
    a, b, c, x, y, z = (np.where(text[at + 3 + k] == text[at + 3], symbol[at + 3 + k], 0) for k in (-3, -2, -1, 1, 2, 3))
    a = np.where(b > 0, a, 0)
    z = np.where(y > 0, z, 0)
    joined, split = np.zeros(len(at), "f4"), np.zeros(len(at), "f4")
    for total, run in ((joined, (a, b, c, x, y, z)), (split, (a, b, c, 0 * c, x, y, z))):
        for k in range(3, len(run)):
            p = log_p[(run[k - 3] << 15) | (run[k - 2] << 10) | (run[k - 1] << 5) | run[k]]
            total += np.where((run[k] > 0) | (run[k - 1] > 0), p, 0)    # one boundary is enough
    return kept[at[joined - split > JOINED]]


def stretches(data: np.ndarray, starts: np.ndarray, log_p: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, end) of what the channel may have made, in order. Without `log_p` no blank is left out
    but those between single characters."""
    text, first, end = words(data, starts)
    if not len(first):
        return text, first, end
    inner = np.ones(len(data), bool)       # the byte before is of the same text
    inner[starts[:-1][starts[:-1] < len(data)]] = False
    letter, sign = _LETTER[data], _LEET_BYTE[data]
    pound = np.flatnonzero((data[1:] == 0xA3) & (data[:-1] == 0xC2))
    euro = np.flatnonzero((data[2:] == 0xAC) & (data[1:-1] == 0x82) & (data[:-2] == 0xE2))
    foreign = np.concatenate([pound, pound + 1, euro, euro + 1, euro + 2])      # the signs of LEET beyond ASCII
    letter[foreign], sign[foreign] = False, True
    inside = np.zeros(len(data) + 1, "i8")
    runs = letter.copy()
    runs[1:] &= ~letter[:-1]
    inside[1:] = np.cumsum(runs)
    n_runs = inside[end] - inside[first] + (letter[first] & ~runs[first])
    leet = np.zeros(len(data), bool)       # a sign right before or after a letter
    leet[1:] |= sign[1:] & letter[:-1] & inner[1:]
    leet[:-1] |= sign[:-1] & letter[1:] & inner[1:]
    low = LOWER[data]
    leet[1:] |= letter[1:] & (low[1:] == low[:-1]) & inner[1:] & (data[1:] < 128)     # a doubled letter
    marks = np.concatenate([[0], np.cumsum(leet)])
    odd = (n_runs > 1) | ((marks[end] > marks[first]) & (n_runs > 0))
    # single letters and signs, three or more in a row and a letter among them
    long = end - first
    lead = _LEAD[data[first]]
    alone = letter[first] & (long - lead == 1)
    width = np.where(data[first] < 128, 1, np.where(data[first] < 0xE0, 2, 3))
    single = alone | (sign[first] & (long == width))
    joined = single[1:] & single[:-1] & (text[1:] == text[:-1])
    begin = np.r_[True, ~joined]
    group = np.cumsum(begin) - 1
    size = np.bincount(group)[group]
    spaced = single & (size >= 3) & (np.bincount(group, alone)[group] > 0)
    if log_p is not None and len(data) > 2:
        # words with a blank that is better left out
        after = np.searchsorted(first, _blanks_left_out(data, inner, log_p) + 1)
        after = after[~spaced[after] & ~spaced[after - 1]]
        chunk = np.zeros(len(first), bool)
        chunk[after] = chunk[after - 1] = True
        linked = joined & spaced[1:]
        linked[after - 1] = True
        begin = np.r_[True, ~linked]
        group = np.cumsum(begin) - 1
        spaced |= chunk
    take = np.flatnonzero((odd & ~spaced) | (spaced & begin))
    last = np.r_[np.flatnonzero(begin)[1:], len(first)] - 1
    stop = np.where(spaced[take], end[last[group[take]]], end[take])
    return text[take], first[take], stop


def restore(data: np.ndarray, starts: np.ndarray, restorer: Restorer) -> list[bytes]:
    """The texts of a piece with what was decoded in its place."""
    text, first, end = stretches(data, starts, np.frombuffer(restorer.log_p, "f4"))
    raw = data.tobytes()
    out = []
    cuts = np.searchsorted(text, np.arange(len(starts)))
    for n in range(len(starts) - 1):
        a, b = starts[n], starts[n + 1]
        if cuts[n] == cuts[n + 1]:
            out.append(raw[a:b])
            continue
        parts, at = [], a
        for f, e in zip(first[cuts[n]:cuts[n + 1]].tolist(), end[cuts[n]:cuts[n + 1]].tolist()):
            parts += [raw[at:f], restorer(raw[f:e].decode("utf-8", "replace")).encode("utf-8", "replace")]
            at = e
        out.append(b"".join([*parts, raw[at:b]]))
    return out


def evidence(texts: list[bytes], only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash), each once, of the words of restored texts, of their beginnings, and marked anew of those that two
    different words share. `only` is a table of the leading 20 bits of the hashes wanted."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    data = np.frombuffer(b"\n".join([*texts, b""]), "u1")
    letter = _LETTER[data]
    edge = np.diff(np.concatenate([[0], letter.view("i1"), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.searchsorted(starts, first, "right") - 1
    run = running_hash(data)
    word = stretch_hashes(run, first, end)
    found = []
    for n in (0, *PREFIXES):
        at = np.flatnonzero(end - first > n) if n else np.arange(len(first))
        h = stretch_hashes(run, first[at], first[at] + n) ^ np.uint64(n) if n else word
        if only is not None:
            wanted = only[h >> np.uint64(44)]
            at, h = at[wanted], h[wanted]
        found.append((text[at], h, word[at]))
    text, h, word = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((word, h, text))
    text, h, word = text[order], h[order], word[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (h[1:] != h[:-1])][:len(text)]
    again = np.r_[False, ~new[1:] & (word[1:] != word[:-1])][:len(text)]
    group = np.unique((np.cumsum(new) - 1)[again])
    text, h = text[new], h[new]
    return np.concatenate([text, text[group]]), np.concatenate([h, h[group] ^ _TWICE])


def lower_bound(hits: np.ndarray, n: np.ndarray, z: float = CONFIDENCE) -> np.ndarray:
    """Of a share of which `hits` of `n` are seen (Wilson); 0 where n is 0."""
    m = np.maximum(n, 1)
    p = hits / m
    low = (p + z * z / (2 * m) - z * np.sqrt(np.maximum(p * (1 - p) / m + z * z / (4 * m * m), 0))) / (1 + z * z / m)
    return np.where(n > 0, np.clip(low, 0, 1), 0)


@dataclass
class Lexicon:
    rate: float
    hashes: np.ndarray      # ascending
    bound: np.ndarray
    curve: np.ndarray       # of the logistic regression

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> np.uint64(44)] = True
        self.maybe[(self.hashes ^ _TWICE) >> np.uint64(44)] = True

    def scores(self, texts: list[bytes]) -> np.ndarray:
        most, number = np.zeros(len(texts)), np.zeros(len(texts))
        if len(self.hashes):
            text, h = evidence(texts, self.maybe)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            np.maximum.at(most, text[hit], self.bound[at[hit]])
            number = np.bincount(text[hit], minlength=len(texts)).astype("f8")
        return 1 / (1 + np.exp(-np.clip(_terms(most, number, self.rate) @ self.curve, -30, 30)))


def _terms(most: np.ndarray, number: np.ndarray, rate: float) -> np.ndarray:
    m = np.clip(most, min(max(rate, 1e-3), 0.5), 0.999)
    return np.column_stack([np.ones(len(m)), np.log(m / (1 - m)), np.log1p(number)])


def _cover(label: np.ndarray, doc: np.ndarray, feature: np.ndarray, n_features: int) -> np.ndarray:
    """Features that explain the toxic texts: again and again the one of the highest bound, whose toxic
    texts no longer count for the others, so words that only stand beside it are no evidence unless sure."""
    clean = np.bincount(feature[label[doc] == 0], minlength=n_features)
    of_toxic = label[doc] == 1
    doc, feature = doc[of_toxic], feature[of_toxic]
    toxic = np.bincount(feature, minlength=n_features).astype("f8")
    hopeful = lower_bound(toxic, toxic + clean)[feature] >= EVIDENCE     # bounds only fall
    doc, feature = doc[hopeful], feature[hopeful]
    by_feature = np.argsort(feature, kind="stable")
    f_at = np.searchsorted(feature[by_feature], np.arange(n_features + 1))
    by_doc = np.argsort(doc, kind="stable")
    d_at = np.searchsorted(doc[by_doc], np.arange(len(label) + 1))
    bound = np.where(np.bincount(feature, minlength=n_features) > 0, lower_bound(toxic, toxic + clean), 0)
    sure = np.flatnonzero(bound >= SURE)
    left = np.ones(len(label), bool)
    chosen = []
    while n_features and bound[f := int(bound.argmax())] >= EVIDENCE:
        chosen.append(f)
        docs = doc[by_feature[f_at[f]:f_at[f + 1]]]
        for d in docs[left[docs]]:
            toxic[feature[by_doc[d_at[d]:d_at[d + 1]]]] -= 1
        if left[docs].any():
            touched = np.unique(np.concatenate([feature[by_doc[d_at[d]:d_at[d + 1]]] for d in docs[left[docs]]]))
            bound[touched] = np.where(bound[touched] > 0, lower_bound(toxic[touched], (toxic + clean)[touched]), 0)
            left[docs] = False
        bound[f] = 0
    return np.union1d(np.array(chosen, "i8"), sure)


def _lexicon(label, doc, feature, n_features) -> tuple[np.ndarray, np.ndarray]:
    chosen = _cover(label, doc, feature, n_features)
    seen = np.bincount(feature, minlength=n_features)[chosen]
    return chosen, lower_bound(np.bincount(feature, label[doc], minlength=n_features)[chosen], seen)


def fit(label: np.ndarray, text: np.ndarray, h: np.ndarray) -> Lexicon:
    """Evidence with its bounds. The curve is fitted to either half's bounds from the other half's evidence."""
    n = len(label)
    rate = float(label.mean()) if n else 0.0
    curve = np.array([math.log(max(rate, 1e-6) / max(1 - rate, 1e-6)), 0, 0])
    if not 0 < rate < 1:
        return Lexicon(rate, np.zeros(0, "u8"), np.zeros(0), curve)
    hashes, feature = np.unique(h, return_inverse=True)
    most, number = np.zeros(n), np.zeros(n)
    half = np.arange(n) % 2
    for side in (0, 1):
        learn = half[text] == side
        chosen, bound = _lexicon(label, text[learn], feature[learn], len(hashes))
        value = np.zeros(len(hashes))
        value[chosen] = bound
        np.maximum.at(most, text[~learn], value[feature[~learn]])
        number += np.bincount(text[~learn], value[feature[~learn]] > 0, minlength=n)
    x, curve = _terms(most, number, rate), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        curve = curve + np.linalg.solve(hessian, x.T @ (label - p) - 1e-2 * curve)
    chosen, bound = _lexicon(label, text, feature, len(hashes))
    order = np.argsort(chosen)
    return Lexicon(rate, hashes[chosen[order]], bound[order], curve)


def _sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col, text_col, label_col, rows, log_p):
    chosen = (labels.filter(learn & F.col(label_col).isNotNull())
              .select(F.col(id_col).alias("chosen"), F.col(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("chosen"), "label").limit(rows))    # so many rows at most
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("chosen")).select(
        F.xxhash64("chosen", text_col).alias("doc"), "label", F.col(text_col).cast("string"))

    def run(batches):
        restorer = Restorer(log_p)
        for batch in batches:
            docs, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part, data, starts in pieces(batch.column(2), PIECE):
                text, h = evidence(restore(data, starts, restorer))
                yield pa.RecordBatch.from_arrays([pa.array(docs[part][text]), pa.array(labels[part][text]),
                                                  pa.array(h.view("i8"))], ["doc", "label", "hash"])

    pairs = stored(sample.mapInArrow(releasing(run), "doc bigint, label double, hash bigint"), "evidence")
    # what fewer than two toxic texts have, or mostly others, is none
    some = (pairs.groupBy("hash").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
            .filter("toxic >= 2 and toxic >= 0.5 * n").select("hash"))
    texts = sample.groupBy("doc").agg(F.max("label").alias("label")).toArrow()      # `rows` at most
    got = pairs.join(some, "hash").select("doc", "hash").toArrow()
    docs_, order = np.unique(texts["doc"].to_numpy(), return_index=True)
    return fit(texts["label"].to_numpy()[order], np.searchsorted(docs_, got["doc"].to_numpy()),
               got["hash"].to_numpy().view("u8"))


def score(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", learned_rows: int = LEARNED_ROWS, with_text: bool = False,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, the columns in `keep`, and with `with_text` the restored text; one row per row of `docs`.

    `labels` has the id and the label; rows that meet `learn` and have a label are learned from, at
    most `learned_rows` of them. Null texts count as empty and get the score of a text without
    evidence; they are not decoded. Repeated rows and ids count as rows. Whole texts are read, however long. An
    empty table gives no rows; without labels all scores are near 0. Only the text enters a score; other columns are not read.
    """
    log_p = log_probabilities(gram_counts(docs.select(F.col(text_col).cast("string"))))
    lexicon = _sample(docs, labels, learn, id_col, text_col, label_col, learned_rows, log_p)

    def run(batches):
        restorer = Restorer(log_p)
        for batch in batches:
            out, texts = np.zeros(batch.num_rows), []
            for part, data, starts in pieces(batch.column(1), PIECE):
                restored = restore(data, starts, restorer)
                out[part] = lexicon.scores(restored)
                if with_text:
                    texts += [t.decode("utf-8", "replace") for t in restored]
            columns = [batch.column(0), pa.array(out), *([pa.array(texts, pa.string())] if with_text else []),
                       *[batch.column(i) for i in kept]]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    own = [k for k in keep if k != text_col or kinds[k] != "string"]    # the text itself goes over once
    kept = [1 if k not in own else 2 + own.index(k) for k in keep]
    types = ["bigint", "double", *(["string"] if with_text else []), *[kinds[k] for k in keep]]
    names = ["doc_id", "score", *(["restored"] if with_text else []), *keep]     # `keep` may repeat the others
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("given text"),
                       *[F.col(k).alias(f"kept {k}") for k in own]).mapInArrow(
        releasing(run), ", ".join(f"c{i} {t}" for i, t in enumerate(types))).toDF(*names)
