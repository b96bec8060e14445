"""Packing by exact round trip, mixing against its own bounds, and edge cases."""

import math
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweir.llm import mixing
from clickweir.llm.catalog import tokenizer_json
from clickweir.llm.packing import Encoder, assign, capacities, pack
from clickweir.session import stored

ODD = ["", "  a  b ", " x\n y", "don't 's 're'll <|endoftext|>\t\n z  ", "日本 語 ÷ a÷b ªº µm ſ ɏa.", "a" * 300 + " " + "b," * 50,
       " .", "x ...,, y!?", "  　x \x1c y", "A.B. c.d", "ends. ", "one"]


def plain_ids(texts):
    t = Tokenizer.from_str(tokenizer_json())
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_is_the_tokenizer(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    encode = Encoder(tokenizer_json(), cached_words=50)
    expected = [np.array(ids, "<u4").tobytes() for ids in plain_ids(texts)]
    assert encode(texts) == expected and encode(texts[::-1]) == expected[::-1]


@pytest.mark.parametrize("lengths", [[], [1], [1024], [5000, 3, 700, 700, 1], [1] * 2000, list(range(1, 300, 7))])
def test_assignment_fills_all_sequences(lengths):
    room, filled, got = capacities(sum(lengths)), {}, {}
    for d, at, n, s, offset in assign(lengths):
        assert n > 0 and filled.get(s, 0) == offset
        filled[s] = offset + n
        got.setdefault(d, []).append((at, n))
    assert filled == dict(enumerate(room)) and all(c == 1024 or c & (c - 1) == 0 for c in room)
    for d, n in enumerate(lengths):
        at = 0
        for start, length in sorted(got[d]):
            assert start == at
            at += length
        assert at == n


def test_cost_is_balanced():
    lengths = [900] * 8 + [100] * 80
    cost = {}
    for _, _, n, s, _ in assign(lengths):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    full = [c for s, c in cost.items() if capacities(sum(lengths))[s] == 1024]
    assert max(full) / min(full) < 1.5


def test_pack_round_trip(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD * 3)] + [(7, None, 1), (None, "no id", 2), (5, ODD[5], 3), (6, "word " * 9000, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start int").repartition(3)
    got = pack(df, tokenizer_json(), group_tokens=4000, with_ids=True).collect()
    assert sum(r.length for r in got) == sum(len(ids) + 1 for ids in plain_ids([t or "" for _, t, _ in rows]))
    by_sequence = {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0
    pieces = sorted((r.start, tuple(r.ids)) for r in got if r.doc_id == 6 and r.doc_tokens > 5000)
    assert [i for _, ids in pieces for i in ids] == [*plain_ids(["word " * 9000])[0], 0]
    assert pack(df.limit(0), tokenizer_json()).collect() == []


def targets(sizes, most=3):
    """Targets by sharing the excess again and again."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total, out, free = sum(sizes.values()), {}, set(sizes)
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: most * sizes[s] for s in over}
        free -= over
    return out


def corpus(spark, scale=40):
    sizes = {"a": 900, "b": 20, "c": 300, None: 150, "": 60, "é": 5, "z": 700}
    rows, n = [], 0
    for source, words in sizes.items():
        for i in range(scale):
            rows.append((n, " ".join(f"w{j}" for j in range(words * (i % 3) // 2)), source, 0, "k"))
            n += 1
    rows += [(n, None, "a", 0, "k"), (n + 1, "", "only empty", 0, "k"), (None, "some words \t here", "a", 0, "k"), *[(3, "x y z", "a", 0, "k")] * 3]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string, block int, tie string")


def test_mix(spark):
    rows, df = corpus(spark)
    got = mixing.mix(df).collect()
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = targets(sizes)
    by_id = {(i, len((t or "").split())): s for i, t, s, *_ in rows}
    taken = {}
    assert len(got) == len(rows)
    for r in got:
        source = by_id[r.doc_id, r.size]
        assert r.source_size == sizes[source] and r.taken <= 3 * r.size
        assert r.target == pytest.approx(expected[source])
        taken[source] = taken.get(source, 0) + r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(3 * mixing.BLOCK_WORDS, 0.02 * target)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).collect() == []


def spark_hash(*values):
    """xxhash64 of a row of values: each is hashed with the hash before it as the seed, and null leaves it."""
    h = 42
    for kind, v in values:
        if v is not None:
            data = v.encode() if kind == "s" else struct.pack("<i" if kind == "i" else "<q", v)
            h = xxhash.xxh64_intdigest(data, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_mix(rows):
    """`taken` of every row by plain loops over documents, shards, slots and blocks."""
    seed = ("i", mixing.SEED)
    docs = [(i, len(mixing_words(t)), s, signed(spark_hash(("s", t)))) for i, t, s in rows]
    sizes = {}
    for _, n, s, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    want, order = targets(sizes), sorted(sizes, key=lambda s: (s is None, s))
    buckets = max(1, -(-len(docs) // mixing.BUCKET_ROWS))
    placed, start = [], dict.fromkeys(sizes, 0)
    for i, n, s, tie in sorted(docs, key=lambda d: (signed(spark_hash(seed, ("l", d[0]), ("l", d[3]))) % buckets, d[0] is not None, d[0] or 0, d[3], d[1])):
        placed.append((i, n, s, start[s]))
        start[s] += n
    blocks = {s: -(-n // mixing.BLOCK_WORDS) for s, n in sizes.items() if n}
    share = {s: want[s] * blocks[s] / sizes[s] for s in order if s in blocks}
    wanted = {s: int(x + 0.5) for s, x in share.items()}
    slots = sum(wanted.values())
    n_drawn = max(0, (slots - math.isqrt(slots) * mixing.CORRECTED) // mixing.SHARD_SLOTS)
    draws, bounds, upto = {s: 0 for s in share}, [], 0.0
    for s in share:
        upto += share[s]
        bounds.append((s, upto / sum(share.values())))
    bounds[-1] = (bounds[-1][0], 1.0)
    for shard in range(n_drawn):
        for i in range(mixing.SHARD_SLOTS):
            u = (spark_hash(seed, ("l", shard), ("l", i)) >> 11) * 2.0 ** -53
            draws[next(s for s, high in bounds if u < high)] += 1
    times = {}
    for s, n in draws.items():
        for k in range(max(n, wanted[s])):
            epoch, x = divmod(k, blocks[s])
            if epoch < mixing.MOST_EPOCHS:
                for r in range(1, mixing.ROUNDS + 1):
                    key = [("s", s), ("l", epoch)]
                    partner = (signed(spark_hash(seed, ("s", "key"), ("i", r), *key)) % blocks[s] - x) % blocks[s]
                    if spark_hash(seed, ("s", "bit"), ("i", r), ("l", max(x, partner)), *key) & 1:
                        x = partner
                times[s, x] = times.get((s, x), 0) + 1
    out = []
    for i, n, s, at in placed:
        out.append((i, n, sum(times.get((s, w // mixing.BLOCK_WORDS), 0) for w in range(at, at + n))))
    return sorted(out, key=str), n_drawn


def mixing_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_taken_by_plain_loops(spark, monkeypatch):
    rows = [(i, t, s) for i, t, s, *_ in corpus(spark, 12)[0]]
    rows += [(10_000 + i, " ".join(f"x{j}" for j in range(4000)), "za"[i % 3 == 0]) for i in range(20)]
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 256)
    expected, n_drawn = plain_mix(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = sorted(((r.doc_id, r.size, r.taken) for r in mixing.mix(df, shard_slots=256).collect()), key=str)
    assert n_drawn > 5 and got == expected


def test_mixed_texts_are_what_the_mix_takes(spark):
    rows, df = corpus(spark, 12)
    texts = mixing.mixed_texts(df)
    assert set(texts.columns) == {"doc_id", "epoch", "text", "source", "block", "tie"}
    got = texts.collect()
    taken = {}
    for r in mixing.mix(df).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    found = {}
    for r in got:
        found[r.doc_id] = found.get(r.doc_id, 0) + len(r.text.split())
    assert found == {k: v for k, v in taken.items() if v}
    whole = {i: (t or "").split() for i, t, *_ in rows}
    for r in got:
        words = iter(whole[r.doc_id])
        assert all(w in words for w in r.text.split())     # in order, none twice
    assert mixing.mixed_texts(df.limit(0)).collect() == []


def test_mixed_texts_keep_white_space(spark):
    odd = ["  \t first\n\n    indented  line\r\n\tend \n", "x", "\x0b a\u00a0b\u3000c \x0c"]
    lines = "".join(f"{' ' * (i % 4)}w{i}{(' ', chr(10), '  ', chr(10) * 2)[i % 4]}" for i in range(500))
    rows = [(i, t, "s") for i, t in enumerate([*odd, lines])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mixed_texts(df).collect()      # one source: every block is taken once
    assert sorted((r.doc_id, r.text) for r in got) == [(i, t) for i, t, _ in rows]
    two = spark.createDataFrame([(0, lines, "a"), (1, lines, "b")], "doc_id bigint, text string, source string")
    words, cut = lines.split(), 0
    for r in mixing.mixed_texts(two).collect():
        taken = [int(w[1:]) for w in r.text.split()]
        parts = [[taken[0]]]
        for a, b in zip(taken, taken[1:]):
            parts[-1].append(b) if b == a + 1 else parts.append([b])
        at = [lines.index(f"w{i}{(' ', chr(10))[i % 2]}") for i in range(500)] + [len(lines)]
        spaced = [lines[at[p[0]]:at[p[-1] + 1]] for p in parts]     # up to the next word, whose indentation comes before it
        assert r.text == "\n".join(spaced)
        cut += len(parts) > 1
    assert cut and len(words) == 500


def final_joins(df, key):
    """The joins by the column `key` in the plan that ran, by their names."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    return {m[0] for line in plan.splitlines() if f"{key}#" in line and (m := re.search(r"\w+Join\w*", line))}


def test_slots_and_texts_are_not_broadcast(spark):
    df = corpus(spark, 12)[1]
    assert final_joins(mixing.mix(df), "t_block") == {"SortMergeJoin"}
    texts = mixing.mixed_texts(df)
    assert final_joins(texts, "t_block") == {"SortMergeJoin"} and final_joins(texts, "k1") == {"SortMergeJoin"}


def test_many_sources_and_few_shards_broadcast_the_sources(spark):
    n = 2000
    shares = stored(spark.range(n).select(F.concat(F.lit("s"), "id").alias("source"), (F.col("id") / n).alias("low"),
                                          ((F.col("id") + 1) / n).alias("high")))
    counts, shards = mixing.drawn_slots(shares, 400_000)
    assert 80 < shards < 100 and counts.agg(F.sum("draws")).first()[0] == shards * mixing.SHARD_SLOTS
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[cell#\d+L\], \[cell#\d+L\], Inner, BuildRight", plan)


def test_permutation(spark):
    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("s"), F.lit(0)).alias("p"))
        got = [r.p for r in df.collect()]
        assert sorted(got) == list(range(n)) and (n < 64 or got != sorted(got))


def test_targets_of_few_sources(spark):
    for sizes in ({"a": 10}, {"a": 1, "b": 1000}, {"a": 0, "b": 5}, {"a": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(targets(sizes) if sum(sizes.values()) else {"a": 0.0})
