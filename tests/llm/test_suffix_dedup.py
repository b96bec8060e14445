"""Suffix-array removal against brute force, its parts, and edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweir.llm import suffix_dedup
from clickweir.llm.suffix_dedup import remove_repeats
from clickweir.llm.suffix_runs import CONTEXT, GRAM, REACH, WINDOW, Run, anchors, common_prefixes, merge, squeeze, unsqueeze
from clickweir.llm.utf8 import pieces

LAST = 1 << 62


def brute(rows):
    """(n_bytes, n_removed, n_spans, sha) of each row, sorted."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < (LAST if i is None else i):
                gone[p:p + 50] = b"\1" * 50
        spans = sum(1 for q, g in enumerate(gone) if g and (q == 0 or not gone[q - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    alphabet = ["ab ", "aé日 ", "abcdefghijklmnopqrstuvwxyz  "][seed % 3]
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(30, 140))) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
                       for _ in range(rng.randint(0, 5)))
        rows.append((rng.choice([i, i, i, 7, None]), text if rng.random() > 0.05 else None))
    rows += rows[:3] + [(1000, rows[5][1]), (2, "x" * 300), (3, "x" * 49), (4, "x" * 400), (5, "")]
    return rows


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_like_brute_force(spark, seed, monkeypatch):
    if seed == 1:
        monkeypatch.setattr(suffix_dedup, "HOT_GRAM", 2)    # most windows go by their hashes
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(remove_repeats(df, bucket_bytes=1500)) == brute(rows)


def test_documents_like_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = found(remove_repeats(docs))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert plain == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    rows = [(1, "a" * 60, 5, "x"), (2, "a" * 60, 6, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, bucket int, id string")
    assert [r[1:4] for r in found(remove_repeats(df))] == [(60, 0, 0), (60, 60, 1)]
    assert remove_repeats(df.limit(0)).collect() == []
    kept = {r.doc_id: (r.kept, r.id, r.bucket) for r in remove_repeats(df, with_text=True, keep=("id", "bucket")).collect()}
    assert kept == {1: ("a" * 60, "x", 5), 2: ("", "y", 6)}


def test_text_that_loses_part_of_a_character(spark):
    shared = "b" * 49
    rows = [(1, shared + "é"), (2, shared + "è"), (3, None)]     # both begin with the byte C3
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in remove_repeats(df, with_text=True).collect()}
    assert kept == {1: shared + "é", 2: "", 3: None}


def test_every_window_has_one_anchor():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 200))) for _ in range(40)] + ["z" * 120]
    for _, data, starts in pieces(pa.array(texts)):
        a = anchors(data, starts)
        covered = np.zeros(len(data), int)
        for at, first, last in zip(a.at, a.first, a.last):
            assert 0 <= at - last and at - first <= REACH and at + GRAM <= last + WINDOW
            covered[first:last + 1] += 1
        expected = np.zeros(len(data), int)
        for s, e in zip(starts[:-1], starts[1:]):
            expected[s:max(s, e - WINDOW + 1)] = 1
        assert (covered == expected).all()


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_loser_tree_merges_front_coded_runs(k):
    rng = np.random.default_rng(k)
    runs, everything = [], []
    for _ in range(k):
        rows = np.zeros((int(rng.integers(1, 60)), CONTEXT), "u1")
        rows[:, :6] = rng.integers(0, 3, (len(rows), 6))
        rows = np.frombuffer(b"".join(sorted(map(bytes, rows))), "u1").reshape(-1, CONTEXT)
        n = np.arange(len(rows))
        run = Run.from_bytes(Run.of(rows, n.astype("<i8"), n.astype("<i4"), n.astype("<i4"), n.astype("u1"), n.astype("u1")).to_bytes())
        assert b"".join(run.strings()) == rows.tobytes()
        runs.append(run)
        everything += list(map(bytes, rows))
    of, place, strings, share = merge(runs)
    assert strings == sorted(everything)
    assert share.tolist() == common_prefixes(np.frombuffer(b"".join(strings), "u1").reshape(-1, CONTEXT)).tolist()
    assert [runs[r].strings()[p] for r, p in zip(of, place)] == strings


def test_copies_are_found_by_either_join(spark, monkeypatch):
    rows = [(i, f"{'same text ' * 8}{i // 40}") for i in range(400)] + [(7, "once")]
    marks = spark.createDataFrame(rows, "id bigint, sha string")
    least = marks.groupBy("sha").agg(F.min("id").alias("least")).select(F.col("sha").alias("c_sha"), "least")
    found = []
    for most in (1 << 40, 0):
        monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", most)
        found.append(sorted(map(tuple, suffix_dedup._with_least(marks, least).select("id", "sha", "least").collect())))
    assert found[0] == found[1] and len(found[0]) == 401


def test_left_sides_of_one_hash_are_told_apart():
    """Without the multiplier most left sides share their hash; the windows found stay the same."""
    rng = np.random.default_rng(7)
    runs = []
    for k in range(3):
        rows = np.zeros((4000, CONTEXT), "u1")
        rows[:, WINDOW:] = rng.integers(0, 2, (len(rows), CONTEXT - WINDOW)) * (rng.random((len(rows), 1)) < 0.7)
        rows[:, 40] = rng.integers(0, 2, len(rows))
        rows = rows[np.lexsort(rows.T[::-1])]
        n = len(rows)
        before = rng.integers(0, REACH + 1, n).astype("u1")
        runs.append(Run.of(rows, rng.integers(0, 50, n).astype("<i8"), np.arange(n).astype("<i4"), np.full(n, 100, "<i4"), before,
                           np.minimum(before + 1, rng.integers(1, 26, n)).astype("u1")))
    found = [sorted(zip(*(x.tolist() for x in suffix_dedup._removed_windows(runs, **mix)))) for mix in ({}, {"mix": 0})]
    assert found[0] == found[1] and len(found[0]) > 1000


def test_squeezed_columns_come_back():
    a, b = np.array([1, 2 ** 40, 3], "<u8"), np.array([7, 8, 9], "u1")
    x, y = unsqueeze(squeeze(a, b), "<u8", "u1")
    assert (x == a).all() and (y == b).all()
    assert [len(c) for c in unsqueeze(squeeze(a[:0], b[:0]), "<u8", "u1")] == [0, 0]
