"""Near copies of texts against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweir.llm import near_texts


def groups(rows, shingle=5, similarity=0.8):
    """The smallest id of each group of near copies, by all pairs of texts."""
    sets = [near_texts.shingles(t, shingle) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min(least.get(x, i), i, key=lambda v: (v is None, v or 0))
    return sorted(least.values(), key=str)


def corpus(seed=1, n=30):
    rng = random.Random(seed)
    rows = []
    for g in range(n):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(120, 500))]
        rows.append((100 * g, " ".join(base)))
        for c in range(rng.randint(0, 4)):      # a changed word costs up to five shingles
            copy = list(base)
            for _ in range(max(1, len(base) // 200)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 400)}"
            rows.append((100 * g + c + 1, " ".join(copy).replace("w", "W", c)))
    return rows


def test_groups_of_near_copies(spark):
    rows = corpus() + [(5001, ""), (5002, None), (5003, " \n"), (5004, "one two"), (5005, "One  TWO"), (5006, "two one"), (5007, "one two three four five")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id bigint, text string, node string, p0 int").repartition(4)
    kept = near_texts.one_of_each(df)
    assert kept.columns == df.columns
    got, expected = {r.doc_id for r in kept.collect()}, set(groups(rows))
    assert expected <= got and len(got - expected) <= 0.03 * len(rows), got - expected
    assert near_texts.one_of_each(df.limit(0)).collect() == []


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"v{i}" for i in range(200))
    rows = [(None, text)] * 3 + [(4, text + " more")] * 2 + [(None, "alone")] * 2 + [(9, "x " * 40_000), (8, "x " * 40_001)]
    got = near_texts.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id, len(r.text)) for r in got), key=str) == [(4, len(text) + 5), (8, 80_002), (None, 5)]


def test_a_large_group_makes_few_pairs(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:p], f"y{i}", *base[p + 1:]])) for i, p in ((i, rng.randrange(300)) for i in range(2000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert [r.doc_id for r in near_texts.one_of_each(df, hot_key=64).collect()] == [0]
    texts = spark.createDataFrame([(i, *near_texts.word_prints(t).view("i8").tolist()) for i, t in rows],
                                  "node bigint, " + ", ".join(f"p{k} bigint" for k in range(near_texts.PRINTS)))
    assert near_texts._candidates(texts, near_texts.PRINTS, 64).count() < 100 * len(rows)


def by_close_pairs(rows):
    """The smallest ids of the groups, by every pair of texts with a close fingerprint and alike by 0.8 or more."""
    sets, marks = [near_texts.shingles(t) for _, t in rows], [near_texts.word_prints(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) and np.bitwise_count(marks[i] ^ marks[j]).min() <= 3:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min(least.get(x, i), i)
    return sorted(least.values())


def shuffled(seed=7, groups=8):
    """Texts of the same words, so of the same fingerprints, in several orders; of each order two or three near copies."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(150)]
        for order in range(5):
            rng.shuffle(base)
            for c in range(rng.randint(2, 3)):
                copy = list(base)
                for at in rng.sample(range(149), c):       # neighbours change places, or a word is another one
                    copy[at], copy[at + 1] = (copy[at + 1], copy[at]) if g % 2 else (f"n{at}", copy[at + 1])
                rows.append((1000 * g + 10 * order + c, " ".join(copy)))
    return rows


@pytest.mark.parametrize("hot_key", [4, near_texts.HOT_KEY])
def test_links_beside_the_forest_are_kept(spark, hot_key):
    rows = shuffled()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    expected = by_close_pairs(rows)
    assert len(expected) < len(rows) / 2
    assert sorted(r.doc_id for r in near_texts.one_of_each(df, hot_key=hot_key).collect()) == expected


@pytest.mark.parametrize("tile", [16, near_texts.OPEN_TILE])
def test_close_texts_that_are_not_alike_never_leave_as_pairs(spark, monkeypatch, tile):
    """Long texts of the same words in 120 orders: every pair is close, and bounds rule none out."""
    rng, rows = random.Random(11), []
    base = [f"w{i}" for i in range(900)]
    for order in range(120):
        rng.shuffle(base)
        rows.append((10 * order, " ".join(base)))
    rows += [(10 * o + 1, rows[o][1].rsplit(" ", 1)[0] + " end") for o in range(0, 120, 7)]
    sizes, stored = [], near_texts.stored

    def counting(df, label):
        out = stored(df, label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(near_texts, "stored", counting)
    if hasattr(near_texts, "_open_sorted"):
        found = near_texts._open_sorted
        monkeypatch.setattr(near_texts, "_open_sorted", lambda b, similarity: found(b, similarity, tile))
    kept = near_texts.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert sorted(r.doc_id for r in kept.collect()) == [10 * o for o in range(120)]
    assert max(sizes) <= 15 * len(rows)      # 9,453 pairs


def test_sketches_bound_the_difference():
    rng = random.Random(3)
    for _ in range(200):
        base = [f"w{rng.randint(0, 50)}" for _ in range(rng.randint(1, 300))]
        other = [w if rng.random() < 0.9 else "x" for w in base][:rng.randint(1, 300)]
        a, b = " ".join(base), " ".join(other)
        (n, x), (m, y) = near_texts.sketch(a), near_texts.sketch(b)
        differ = len(near_texts.shingles(a) ^ near_texts.shingles(b))
        assert max(abs(n - m), int(np.bitwise_count((x ^ y).view("u8")).sum())) <= differ


@pytest.mark.parametrize("k", range(near_texts.PRINTS))
def test_prints_are_weighted_majorities(k):
    from xxhash import xxh64_intdigest

    mask = (1 << 64) - 1
    total, weight = np.zeros(64), 0.0
    for word, n in ((b"a", 4), (b"b", 1), (b"c", 9)):
        h = (xxh64_intdigest(word, 42) + (k + 1) * 0x9E3779B97F4A7C15) & mask
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & mask
        h ^= h >> 31
        total += n ** 0.5 * np.array([h >> i & 1 for i in range(64)])
        weight += n ** 0.5
    expected = sum(1 << i for i in range(64) if 2 * total[i] > weight)
    assert int(near_texts.word_prints("a b c C c c A c a c c a c c")[k]) == expected


def test_recall_on_documents(spark, sf):
    """Of the groups by all pairs, nearly all are found, and nothing else is dropped."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    kept = {r.doc_id for r in near_texts.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    expected = set(groups(rows))
    assert expected <= kept and len(kept - expected) <= 1
