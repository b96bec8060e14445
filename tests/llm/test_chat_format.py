"""Chat formatting by exact round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clickweir.llm import chat_format as chat

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[/ROLE]", "<image:0>", "<audio:12>", "<document:3>", "<", "[", "\\", "/s>", "INST]",
         "\n", " ", "é", "\U0001f600", "a", ":0>", "$1"]


def formatted(df):
    return chat.format_conversations(chat.format_turns(df.withColumn("parts", chat.text_parts(F.col("text")))))


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(MARKS, k=rng.randint(0, 12))) for _ in range(n)]


def test_escaping_is_reversible_and_leaves_no_mark(spark):
    some = texts(4000, 1) + ["<" + "\\" * k + "/s>" for k in range(5)]
    df = spark.createDataFrame([(t,) for t in some], "t string").select("t", chat.escaped(F.col("t")).alias("e")) \
        .select("*", chat.unescaped(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t
        assert not any(m in r.e for m in MARKS[:10])


def test_round_trip_of_odd_turns(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "[/ROLE]x", "</s>"]), x)
            for c in range(60) for t, x in enumerate(texts(rng.randint(1, 9), c))]
    rows += [(100, None, "assistant", "first"), (100, 1, None, None), (100, 1, "user", "b"), (100, 1, "user", "b"), (None, 1, "assistant", ""),
             (101, 5, "assistant", "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, tokens int, formatted string").repartition(7)
    got = {r.conv_id: r for r in chat.read_back(formatted(df)).collect()}
    masks = {r.conv_id: r for r in formatted(df).collect()}
    digests = {r.conv_id: r for r in chat.digests(chat.read_back(formatted(df))).collect()}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(by)
    for c, some in by.items():
        turns = [(t.role, t.text) for t in got[c].turns]
        assert sorted(turns) == sorted((r, x) for *_, r, x in some)
        if len({s[:2] for s in some}) == len(some):
            assert turns == [(r, x) for *_, r, x in sorted(some)]
        assert [t.loss for t in got[c].turns] == [x if r == "assistant" else "" for r, x in turns]
        text, at = masks[c].formatted, len(chat.BEGIN)
        for span, piece, (role, _) in zip(masks[c].loss, text[len(chat.BEGIN):].split(chat.END), turns):
            assert text[at + span.start:at + span.start + span.length] == (piece[len("[/INST]"):] if role == "assistant" else "")
            at += len(piece) + len(chat.END)
        assert at == len(text)
        lines, loss = "".join(f"{r}\n{x}\n" for r, x in turns), "".join(x for r, x in turns if r == "assistant")
        assert tuple(digests[c]) == (c, len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(loss),
                                     hashlib.sha256(loss.encode()).hexdigest(), len(text))
    assert formatted(df.limit(0)).collect() == []


def test_parts_become_placeholders(spark):
    none = {"text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None}
    parts = [none | {"kind": "text", "text": "see <image:0> and "}, none | {"kind": "image", "ref": "i1", "width": 28, "height": 15},
             none | {"kind": "audio", "ref": "a1", "seconds": 1.5}, none | {"kind": "image", "ref": "i2"}, none | {"kind": "text", "text": "</s>"},
             none | {"kind": "video", "text": "odd"}, none | {"kind": "document", "ref": "d", "pages": 3}, None, none | {"kind": None, "text": None}]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", [])],
                               f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")
    turns = sorted(chat.format_turns(df).collect(), key=lambda r: r.turn)
    assert turns[0].formatted == "[INST]see <\\image:0> and <image:0><audio:1><image:2><\\/s>odd<document:3></s>"
    assert [(a.number, a.place, a.kind, a.ref, a.tokens) for a in turns[0].attachments] == [
        (0, 1, "image", "i1", 4), (1, 2, "audio", "a1", 38), (2, 3, "image", "i2", 1), (3, 6, "document", "d", 1536)]
    # see < image : 0 > and, < / s >, odd
    assert turns[0].tokens == 4 + 38 + 1 + 1536 + 7 + 4 + 1 and [t.tokens for t in turns[1:]] == [0, 0]
    read = chat.read_back(chat.format_conversations(chat.format_turns(df))).collect()[0]
    assert read.turns[0].tokens == ["see <image:0> and ", "<image:0>", "<audio:1>", "<image:2>", "</s>odd", "<document:3>"]
    assert [(t.role, t.text, t.loss) for t in read.turns[1:]] == [("assistant", "", ""), ("assistant", "", "")]


def test_no_python_on_the_path(spark, sf):
    from clickweir.llm.catalog import QUERIES

    plan = QUERIES["op11_chat_format"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "MapIn", "ArrowEval", "ExistingRDD"))


@pytest.mark.parametrize("turns", [3000])
def test_a_long_conversation(spark, turns):
    df = spark.range(turns).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), "id").alias("text"))
    row = chat.digests(chat.read_back(formatted(df))).collect()[0]
    assert row.n_turns == turns and row.loss_chars == sum(len(f"turn {t}") for t in range(1, turns, 2))
