"""Language, quality, toxicity and page text: held-out accuracy, parts, edge cases."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweir.llm import catalog, langid, quality_fm, toxicity
from clickweir.llm.html_extract import extract, main_text, smoothed
from clickweir.llm.utf8 import pieces

SMALL = "/root/testdata/sf0.01"
EDGES = [(1000001, None), (1000002, ""), (1000003, "123 !?"), (1000004, "x" * 200_000), (1000004, "The of and"), (None, "The of and"),
         (1000005, "\x00�")]


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    ones = label == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def with_edges(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = spark.createDataFrame([(i, t, None, None, None, 1) for i, t in EDGES],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    return docs.withColumn("score", F.lit(2)).unionByName(more)


def test_languages(spark):
    df = with_edges(spark)
    got = langid.identify(df, catalog.crc_bucket("doc_id", 4) != 2).collect()
    assert len(got) == 1000 + len(EDGES) and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r.lang for r in df.collect()}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 1000000]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.99
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1000001, 1000002, 1000003)} == dict.fromkeys(
        (1000001, 1000002, 1000003), ("und", 0.0))
    none = langid.identify(df.limit(5), F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert langid.identify(df.limit(0), F.lit(True)).collect() == []


def test_presence_kernel_by_hand():
    texts = ["abab", "bcd", "xyz", ""]
    grams = [{t.encode()[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    model = langid.fit(texts[:2] * 2, ["p", "q"] * 2, landmarks=2)
    known = grams[0] | grams[1]
    (_, data, starts), = pieces(pa.array(texts))
    kernel = model.kernel(model.presence(data, starts, model.table()))
    for i, g in enumerate(grams):
        for j in range(2):
            expected = len(g & grams[j]) / np.sqrt(max(1, len(g & known)) * len(grams[j]))
            assert kernel[i, j] == pytest.approx(expected, abs=1e-6)


def test_quality(spark):
    df = with_edges(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    learn = catalog.crc_bucket("doc_id", 5) != 0
    got = quality_fm.score(df, labels, learn).collect()
    assert len(got) == 1000 + len(EDGES) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    held = labels.filter(~learn & F.col("quality").isNotNull()).collect()
    assert auc(np.array([score[r.doc_id] for r in held]), np.array([r.quality for r in held])) > 0.95
    assert {r.score for r in quality_fm.score(df.limit(3), labels.limit(0), learn).collect()} == {0.5}
    assert quality_fm.score(df.limit(0), labels, learn).collect() == []


def test_pair_sums_in_linear_time():
    rng = np.random.default_rng(0)
    texts = ["One two two three.", "!! !! A", ""]
    (_, data, starts), = pieces(pa.array(texts))
    f = quality_fm.features(data, starts, np.array([18.0, -1, 0]))
    size = (1 << quality_fm.WORD_BITS) + len(quality_fm.STATISTICS) * (quality_fm.BINS + 1)
    machine = quality_fm.Machine([np.array([0.5, 2])] * len(quality_fm.STATISTICS), 0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    cut, index, value = machine.rows(f)
    for t in range(3):
        i, x = index[cut[t]:cut[t + 1]], value[cut[t]:cut[t + 1]]
        pairs = sum(machine.factor[i[a]] @ machine.factor[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert machine.logits(f)[t] == pytest.approx(0.3 + machine.weight[i] @ x + pairs)
    assert f.stats[0][quality_fm.STATISTICS.index("words repeated at once")] == pytest.approx(0.25)


def test_toxicity(spark):
    df = with_edges(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    learn = catalog.crc_bucket("doc_id", 5) != 0
    got = toxicity.score(df, labels, learn, with_text=True, keep=("score", "text")).toDF(
        "doc_id", "toxicity", "restored", "extra", "given").collect()
    assert len(got) == 1000 + len(EDGES) and all(0 <= r.toxicity <= 1 for r in got)
    label = {r.doc_id: r.toxic for r in labels.collect()}
    known = [r for r in got if label.get(r.doc_id) is not None]
    score, truth = np.array([r.toxicity for r in known]), np.array([label[r.doc_id] for r in known])
    assert auc(score, truth) > 0.8 and (score[truth == 0] >= 0.5).mean() < 0.02
    assert {r.extra for r in got if r.doc_id in (1000001, 1000002)} == {1}
    assert toxicity.score(df.limit(0), labels, learn).collect() == []


@pytest.fixture(scope="module")
def restorer():
    words = ["the", "idiot", "moron", "scum", "worthless", "loser", "trash", "pathetic", "of", "and", "are", "you", "book", "tooth"] * 50
    grams = np.zeros(1 << 20, "i8")
    state = 0
    for c in " ".join(words) + " ":
        s = 0 if c == " " else ord(c) - 96
        grams[(state << 5) | s] += 1
        state = ((state << 5) | s) & 0x7FFF
    return toxicity.Restorer(toxicity.log_probabilities(grams))


@pytest.mark.parametrize("given, expected", [
    ("you 1d10t", "you idiot"), ("i d i o t", "idiot"), ("M0R0N!", "moron"), ("$cum", "scum"), ("w0rthl3ss", "worthless"),
    ("the l o s e r", "the loser"), ("p@thet1c", "pathetic"), ("i.d.i.o.t", "idiot"), ("tr@sh", "trash"), ("idiooooot", "idiot"),
    ("sc*m", "scum"), ("1o5er", "loser"), ("the book and the tooth", "the book and the tooth"), ("", ""), ("of 123 and 45", "of 123 and 45")])
def test_restoration(restorer, given, expected):
    (_, data, starts), = pieces(pa.array([given]))
    assert toxicity.restore(data, starts, restorer)[0].decode().strip() == expected


@pytest.mark.parametrize("given, expected", [
    ("1 d 1 0 t", "idiot"), ("you i d 1 0 t", "you idiot"), ("$ c u m", "scum"), ("!diot", "idiot"), ("+rash", "trash"), ("|oser", "loser"),
    ("£oser", "loser"), ("s(um", "scum"), ("<um of", "cum of"), ("mor*n", "moron"), ("iddiot", "idiot"), ("morron", "moron"), ("you traash", "you trash"),
    ("id iot", "idiot"), ("the mor on", "the moron"), ("you wor thless", "you worthless"), ("The Book, you", "The Book, you"),
    ("you are the loser of the book", "you are the loser of the book"), ("1 2 3 4", "1 2 3 4"), ("£500 of", "£500 of"), ("loser!", "loser!")])
def test_restoration_of_all_signs_and_spacings(restorer, given, expected):
    (_, data, starts), = pieces(pa.array([given]))
    assert toxicity.restore(data, starts, restorer)[0].decode().strip() == expected


def test_a_text_is_restored_without_its_neighbours(restorer):
    texts = ["Dog", "Good", "1", "Dog", "a", "1-B", "id", "iot", "i", "d i", "o t", "", "id", " iot", "id ", "iot"]
    (_, data, starts), = pieces(pa.array(texts))
    alone = []
    for t in texts:
        found = list(pieces(pa.array([t])))
        alone.append(toxicity.restore(found[0][1], found[0][2], restorer)[0])
    assert toxicity.restore(data, starts, restorer) == alone


def test_long_stretches_are_decoded_whole(restorer):
    for before in range(18, 46):       # letters before the word, so that it begins 36 to 90 characters in
        spelt = " ".join((("bookandtooth" * 9)[:before]) + "idiot" + "bookandthetooth" * 3)
        assert "idiot" in restorer(spelt).replace(" ", "") and len(spelt) > 128
        (_, data, starts), = pieces(pa.array([spelt]))
        whole = toxicity.restore(data, starts, restorer)[0].decode()
        assert whole == restorer.decode(spelt) and "idi ot" not in whole and "id iot" not in whole


def test_settled_beginnings_change_nothing(restorer, monkeypatch):
    texts = ["1d10t*" * 300, " ".join("the1oserandtr@share") * 40, "*" * 3 + "a*b0" * 700]
    plain = []
    monkeypatch.setattr(toxicity, "SETTLE_STEPS", 1 << 30)
    plain = [restorer.decode(t) for t in texts]
    monkeypatch.setattr(toxicity, "SETTLE_STEPS", 3)
    assert [restorer.decode(t) for t in texts] == plain


def test_viterbi_against_all_paths(restorer):
    """Every way through the lattices of short stretches, scored one symbol after the other."""
    def score(parts):
        state, total = 0, 0.0
        for out, cost in [*parts, (" ", 0.0)]:
            total -= cost
            for c in out:
                s = restorer._symbol(c)
                if s == 0 and state & 31 == 0:
                    continue
                total += restorer.log_p[(state << 5) | s]
                state = ((state << 5) | s) & 0x7FFF
        return total

    rng = random.Random(4)
    stretches = ["1d10t", "s t u", "b00k", "iddiot!", "a*b", "t h e", "@$$", "mor on", "6itch"]
    stretches += ["".join(rng.choices("abotdi10$! *", k=rng.randint(1, 7))) for _ in range(200)]
    for stretch in stretches:
        paths = list(itertools.product(*restorer._arcs(stretch)))
        best = max(map(score, paths))
        texts = {"".join(out for out, _ in p).strip() for p in paths if score(p) > best - 1e-4}
        assert restorer.decode(stretch) in texts, stretch


def test_corpus_counts_cover_all_rows(spark):
    df = spark.createDataFrame([("abc",), ("ab",), (None,), ("é",)], "text string").repartition(3)
    grams = toxicity.gram_counts(df)
    a, b, c = 1, 2, 3
    assert grams[(a << 5) | b] == 2 and grams[(a << 10) | (b << 5) | c] == 1 and grams.sum() > 5


def test_words_beside_evidence_are_none():
    label = np.array([1, 1, 1, 1, 0, 0, 0, 0.0])
    doc = np.array([0, 1, 2, 3, 0, 1, 2, 4, 5])
    feature = np.array([0, 0, 0, 0, 1, 1, 1, 2, 2])    # 0 explains all toxic texts, 1 only stands beside it
    assert toxicity._cover(label, doc, feature, 3).tolist() == [0]


PAGES = [
    ("<article><h1>T</h1><p>a &amp; b<br>c <i>d</i>e</p><ul><li>x</li></ul></article><p>outside</p>", "T\na & b c de\nx"),
    ('<header><h1>Site</h1></header><div class="menu"><a href=x>Home</a></div><div id="content"><h2>Title</h2><p>A long enough paragraph of text '
     'stands here.</p><p>Short.</p></div><div class="sidebar"><p>Side text, long enough too.</p></div><div id="comments"><p>A reader says so.</p>'
     "</div><footer>c</footer>", "Title\nA long enough paragraph of text stands here.\nShort."),
    ("<nav><p>no</p></nav><form><p>Sign up</p></form><p>one<p>two<div>three</div>", "one\ntwo\nthree"),
    ('<div class="ad">Buy</div><article><p>yes<aside>no</aside> and</p><div class="comment-list"><p>no</p></div></article>', "yes\nand"),
    ("<script>x</script><style>y</style>", ""), (None, ""), ("", ""), ("plain &#233; &lt;", "plain é <"), ("<p>cut <b", "cut"),
    ("<article><header><h1>H</h1></header><p>b</p><footer>f</footer></article>", "H\nb")]


P = "An ordinary paragraph of some length, which says one thing after another, and then stops."
Q = "Another paragraph, no shorter than the one above it, goes on with what was said and ends."


@pytest.mark.parametrize("html, text", [
    (f'<article>{P}<section id="discussion">{Q}</section></article>', f"{P}\n{Q}"),
    (f'<article>{P}<div class="social-policy">{Q}</div></article>', f"{P}\n{Q}"),
    (f'<article><p id="notice-2">{Q}</p>{P}</article>', f"{Q}\n{P}"),
    (f'<article>{P}<h2 id="related-work">Related work</h2>{Q}</article>', f"{P}\nRelated work\n{Q}"),
    (f'<article>{P}<h2 id="cookies">Cookies</h2><p>{Q}</p></article>', f"{P}\nCookies\n{Q}"),
    (f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be a number. {P}</p></article>", f"Let x=2 be a number. {P}"),
    (f"<article><p>{P} <label>Note</label></p></article>", f"{P} Note"),
    (f'<article>{P}<article class="comment">{Q}</article></article>', P),
    (f'<main><article>{P}</article><div id="responses"><article class="comment">{Q}</article></div></main>', P),
    (f'<body><div class="social-policy">{P}</div></body>', P),
    (f'<article>{P}<div class="related"><a href=1>One thing</a> <a href=2>Another thing of that kind</a></div></article>', P),
    (f'<article>{P}<div class="cookie-banner">{Q}</div><div class="ad">{Q}</div><p>{Q}</p></article>', f"{P}\n{Q}"),
    (f"<article><p>{P}</p></article><p>Terms.</p><article><p>{Q}</p></article>", f"{P}\n{Q}"),
    (f'<article><p>{P}</p><ul><li>a</li><li><a href=x>b</a></li></ul></article>', f"{P}\na\nb")])
def test_words_of_classes_and_ratios_decide_together(html, text):
    assert main_text(html) == text


def test_ratios_smoothing_and_threshold_by_hand():
    """Lines of doubtful elements stay just where a plain computation puts them in the upper cluster."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        sizes, tags, marked = rng.integers(1, 200, 12), rng.integers(0, 6, 12), rng.random(12) < 0.4
        html = "<article>" + "".join(f'<p{" class=notice" if m else ""}>{"<b>" * t}{chr(97 + i) * n}{"</b>" * t}</p>'
                                     for i, (n, t, m) in enumerate(zip(sizes.tolist(), tags.tolist(), marked))) + "</article>"
        ratio = [n / (1 + t + (i == 0)) for i, (n, t) in enumerate(zip(sizes.tolist(), tags.tolist()))]
        weight = [np.exp(-d * d / 2) for d in range(-3, 4)]
        smooth = [sum(w * ratio[i + d] for w, d in zip(weight, range(-3, 4)) if 0 <= i + d < 12) / sum(weight) for i in range(12)]
        mean = sum(smooth) / 12
        bound = (sum((x - mean) ** 2 for x in smooth) / 12) ** 0.5
        expected = [chr(97 + i) * n for i, n in enumerate(sizes.tolist()) if not marked[i] or smooth[i] >= bound]
        assert main_text(html).split("\n") == expected


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    assert main_text(html) == text


def test_extract(spark):
    df = spark.createDataFrame([(i, None, h, "c") for i, (h, _) in enumerate(PAGES)] + [(None, "u", "x" * 100_000, "c")] * 2,
                               "page_id bigint, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in extract(df).collect()}
    assert got == {**{i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}, None: ("x" * 100_000, 100_000)}
    assert extract(df).count() == len(PAGES) + 2 and extract(df.limit(0)).collect() == []


def test_smoothing_keeps_the_sum():
    r = np.array([0, 0, 0, 0, 10, 0, 0, 0, 0.0])
    assert smoothed(r).sum() == pytest.approx(10) and smoothed(r).argmax() == 4 and len(smoothed(r)) == len(r)
