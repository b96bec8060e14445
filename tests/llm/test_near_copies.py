"""SimHash, components, vectors: against brute force, and edge cases."""

import math
import re

import numpy as np
import pytest
import xxhash

from clickweir.llm import simhash
from clickweir.llm.ann import nearest
from clickweir.llm.components import connected_components
from clickweir.llm.embed_dedup import near_vectors
from clickweir.llm.vectors import Block, estimates
from pyspark.sql import functions as F


def spread(labels, links):
    """Smallest node reachable, by plain spreading."""
    labels = dict(labels)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(labels[a], labels[b])
            if labels[a] != low or labels[b] != low:
                labels[a] = labels[b] = low
                changed = True
    return labels


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "a b c", "É b c d É", "x " * 5000, "a b c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("hot_key", [8192, 3])
def test_components_of_close_fingerprints(spark, hot_key):
    rng = np.random.default_rng(5)
    prints = [0, 1, 3, 7, 15]
    for base in rng.integers(0, 1 << 63, 40, dtype="u8").tolist():
        for _ in range(6):
            p = base
            for bit in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                p ^= 1 << bit
            prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, hot_key).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    close = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3]
    own = {p: p for p in prints}
    assert spread(own, links) == spread(own, close)


def test_near_duplicates_and_who_stays(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long, "a"), (3, long + " end", "b"), (None, long, "c"), (9, None, "d"), (8, " ", "e"), (7, "other words here", "f"),
            (7, "other words here", "f"), (7, "quite different text now", "g")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted(
        [("5", 3), ("3", 3), ("None", 3), ("9", 8), ("8", 8), ("7", 7), ("7", 7), ("7", 7)])
    assert {r.fingerprint for r in got if r.doc_id in (8, 9)} == {"0" * 16}
    stays = simhash.one_of_each(df)
    assert stays.columns == df.columns
    assert sorted(tuple(r) for r in stays.collect()) == sorted([rows[1], rows[4], rows[5], rows[7]])
    assert simhash.near_duplicates(df.limit(0)).collect() == [] and simhash.one_of_each(df.limit(0)).collect() == []


def test_long_chain_is_one_component(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 100), (200, 200)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        base = rng.normal(size=8)
        for _ in range(10):
            rows.append((base + rng.normal(size=8) * rng.choice([0.02, 0.3])).astype("f4").tolist())
    rows += [rows[0]] * 7 + [[2 * x for x in rows[3]], [0.0] * 8, None, [1.0, None] + [0.0] * 6,
                             [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [], [1.0, 2.0, 3.0], [1.0, 2.0, 3.5]]
    return [(i, v) for i, v in enumerate(rows)] + [(None, rows[0])]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, "f8"), np.array(b, "f8")
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_near_vectors(spark, block_rows):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, cell int")
    got = near_vectors(df, block_rows=block_rows, pivots=4).collect()
    good = [(i, v) for i, v in rows if i is not None and usable(v)]
    links = [(i, j) for i, v in good for j, w in good if i != j and len(v) == len(w) and cosine(v, w) >= 0.9]
    label = spread({i: i for i, _ in rows if i is not None}, links)
    expected = {i: (sum(a == i for a, _ in links), label[i], label[i] == i) for i in label}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == expected
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    assert near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [(4096, 1024, 4), (16, 4, 2)])
def test_nearest(spark, sizes):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, rows[4]]], "vec_id bigint, embedding array<float>, rank int")
    got = nearest(df, F.col("vec_id") % 3 == 0, 5, block_rows=sizes[0], query_rows=sizes[1], group_blocks=sizes[2]).collect()
    good = [(i, v) for i, v in rows if i is not None and usable(v)]
    expected = {}
    for i, v in good:
        if i % 3 == 0:
            others = sorted((-cosine(v, w), j) for j, w in good if j != i and len(v) == len(w))
            expected[i] = [round(-s, 9) for s, _ in others[:5]]
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(round(r.score, 9))
        assert abs(r.score - cosine(rows[r.query_id][1], rows[r.vec_id][1])) < 1e-12
    assert found == {i: s for i, s in expected.items() if s}
    copies = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0]
    assert copies == [120, 121, 122, 123, 124]       # ties go to the smaller id
    assert nearest(df.limit(0), F.lit(True)).collect() == []


def test_double_vectors_keep_their_precision(spark):
    """Cosines that single precision cannot tell apart, on both sides of the threshold; and over 1,000 dimensions."""
    tilt = [math.acos(0.9) + d for d in (-1e-10, 1e-10)]
    rows = [(0, [1.0, 0.0]), *[(i + 1, [math.cos(a), math.sin(a)]) for i, a in enumerate(tilt)], (3, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert {r.vec_id: r.n_links for r in near_vectors(df).collect()} == {0: 1, 1: 2, 2: 1, 3: 0}
    first = nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in first] == [1, 2, 3] and first[0].score > 0.9 > first[1].score
    rng = np.random.default_rng(5)
    x = Block.of(np.arange(8), np.ones(8), rng.normal(size=(8, 2500)))
    codes = x.codes.astype("i8") @ x.codes.astype("i8").T
    assert np.allclose(estimates(x, x)[0], codes * x.scale[:, None] * x.scale[None, :], rtol=1e-6)
    assert (Block.from_bytes(x.to_bytes()).vectors == x.vectors).all()


def test_error_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = (Block.of(np.arange(50), np.ones(50), rng.normal(size=(50, 64)) * 10.0 ** rng.integers(-3, 3, (50, 1))) for _ in range(2))
    guess, error = estimates(x, y)
    exact = (x.vectors / x.norms[:, None]) @ (y.vectors / y.norms[:, None]).T
    assert (np.abs(guess - exact) <= error[:, None] + (1 + error[:, None]) * y.error[None, :] + 1e-6).all()
    back = Block.from_bytes(Block.of(x.ids, x.weight, x.vectors.astype("f4")).to_bytes())
    assert (back.vectors == x.vectors.astype("f4")).all()
