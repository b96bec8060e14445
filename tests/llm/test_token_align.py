"""Token alignment against plain loops over all tokens, groups and links."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweir.llm import token_align
from clickweir.llm.byte_bpe import ByteBpe, byte_of_char, pieces, token_bytes
from clickweir.llm.catalog import QUERIES, tokenizer_json

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["", " ", "  a  b ", " x\n y", "don't 's <|endoftext|> </s> <0x0A> <unk>\t\n z  ", "日本 語 ÷ µm ſ ɏa.", "a" * 300, "▁x y", "x\x00y",
       "naïve café — “q” … 1234567 x=y+z;", "\U0001f600 \U0001f469‍\U0001f680 ok", " nbsp　wide", "one"]


def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def plain(rows):
    """Rows of align() by plain loops."""
    a_model = Tokenizer.from_str(tokenizer_json())
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_proto=model())
    byte = byte_of_char()
    out, all_links = [], []
    for doc, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
                   else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append((doc, 0, 0, 0, 0, ""))
            all_links.append([])
            continue
        spans = []
        for side in (a_bytes, b_bytes):
            at, some = 0, []
            for x in side:
                some.append((at, at + len(x)))
                at += len(x)
            spans.append(some)
        groups, at = [], [0, 0]
        for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            sides = []
            for side, ids in enumerate((a, b)):
                first = at[side]
                while at[side] < len(ids) and spans[side][at[side]][1] <= end:
                    at[side] += 1
                sides.append(",".join(map(str, ids[first:at[side]])))
            groups.append("|".join(sides))
        links, j0 = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        out.append((doc, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        all_links.append(links)
    count = Counter(x for links in all_links for x in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(*row[:5], sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), row[5])
            for row, links in zip(out, all_links)]


def got(df, order=str):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=order)


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = QUERIES["op13_token_alignment"](spark, sf)
    assert sorted(df.columns) == sorted(COLUMNS)
    assert got(df) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("heavy", [0, 3, 200_000])
def test_odd_rows(spark, monkeypatch, heavy):
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(3, None), (None, "no id"), (5, ODD[5]), (6, "a word, and more; " * 300)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, n_a int").repartition(3)
    assert got(token_align.align(df, tokenizer_json(), model(), heavy_pairs=heavy)) == sorted(plain(rows), key=str)
    assert token_align.align(df.limit(0), tokenizer_json(), model()).collect() == []


def test_long_texts_are_aligned_in_segments(spark, sf):
    """In this process, where the segment can be made short."""
    text = "\n".join(r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(40).collect()) + " " + "  a  b " * 50
    v = token_align.vocabularies(tokenizer_json(), model())
    whole = align_one(v, [text])
    cut = pieces(text, 200)
    assert "".join(cut) == text and len(cut) > 50
    assert align_one(v, [p if n == 0 else p[1:] for n, p in enumerate(cut)]) == whole


def align_one(v, segments):
    counts, text, same, pair = token_align.align_tokens(v, [v.tokens(s) for s in segments])
    links = Counter()
    for kind, (_, item, n) in (("same", same), ("pair", pair)):
        for i, k in zip(item.tolist(), n.tolist()):
            links[kind, i] += k
    return counts.sum(0).tolist(), b"".join(text), links


def test_long_rows_equal_short_ones(spark):
    rows = [(1, "some words, and others " * 20_000), (2, "some words, and others"), (3, "x" * 20 + " ▁ " + "word " * 70_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(token_align.align(df, tokenizer_json(), model())) == sorted(plain(rows), key=str)


def test_byte_bpe_is_the_tokenizer():
    """Every token's own bytes encode to it, on which the equality of both methods rests, and every character has the same class."""
    general = Tokenizer.from_str(tokenizer_json())
    general.encode_special_tokens = True
    fast = ByteBpe(tokenizer_json())
    assert fast.fast is not None
    table = token_bytes(tokenizer_json())
    for i, b in enumerate(table[:50256]):
        assert [t.id for t in general.model.tokenize("".join(general.id_to_token(i)))] == [i], (i, b)
    some = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(some), 50_000):
        texts = ["".join(f"a{c}1{c} .{c}\n{c}" for c in some[k:k + 50]) for k in range(at, min(at + 50_000, len(some)), 50)]
        for t, e in zip(texts, general.encode_batch_fast(texts, add_special_tokens=False)):
            assert fast.ids(t).tolist() == e.ids
    for t in (" " * 300_000 + "a", "a" * 100_000, "\n" * 100_000 + " x", "ab " * 400_000):    # the first is too deep for the matcher
        assert fast.ids(t).tolist() == general.encode(t, add_special_tokens=False).ids
