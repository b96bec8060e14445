"""The stages of the pipeline on a small corpus, against plain versions; the registered queries."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from clickweir.llm.catalog import ORACLES, QUERIES
from clickweir.session import stored
from test_near_texts import groups
from test_packing_and_mixing import mixing_words, plain_mix
from test_suffix_dedup import brute
from verify import compare, connect


@pytest.fixture(scope="module")
def kept(spark, sf, tmp_path_factory):
    """Each stage's input and result, written and read again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, sf).write.parquet(path)
        done = spark.read.parquet(path)
        out.append((name, docs, done))
        docs = done
    return out


def test_columns_and_order(kept, spark, sf):
    assert [n for n, *_ in kept] == ["toxicity", "simhash near-dedup", "suffix-array dedup", "mixing sources", "packing"]
    for _, _, done in kept[:-1]:
        assert done.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.run(spark, sf).count() == kept[-1][2].count()


def test_clean_documents_stay(kept, spark, sf):
    _, docs, done = kept[0]
    left = {r.doc_id for r in done.collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").collect()
    assert sum(r.doc_id in left for r in labels) >= 0.98 * len(labels)


def test_one_of_each_group(kept):
    """Groups by all pairs of texts: one of each stays, and at most one near copy is missed."""
    _, docs, done = kept[1]
    expected = set(groups([(r.doc_id, r.text) for r in docs.collect()]))
    left = [r.doc_id for r in done.collect()]
    assert expected <= set(left) and len(left) == len(set(left)) <= len(expected) + 1


def test_repeats_go(kept):
    _, docs, done = kept[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lost = {int(i): removed for i, _, removed, *_ in brute(rows)}
    left = {r.doc_id: r.text for r in done.collect()}
    assert set(left) == set(lost)
    for i, t in rows:
        assert left[i] == t if not lost[i] else len(left[i].encode()) <= len(t.encode()) - lost[i]


def test_all_mixed_words_are_packed(kept):
    _, docs, done = kept[4]
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in done.collect()}


def test_stages_on_odd_rows_and_on_none(spark, sf):
    """Null ids and texts, empty, repeated and one huge text, columns that stages use themselves; then an empty table."""
    real = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS).limit(40).collect()]
    odd = [(None, "a text without an id, of some words", "en", "web", None), (9007, None, None, None, None), (9007, "", "", "", 0), (9008, " \n\t ", "en", "web", 4),
           *[(9009, "the same row again and again, and once more", "en", None, 44)] * 3, (9010, "word " * 60_000 + "end", "en", "web", 1)]
    docs = spark.createDataFrame(real + odd, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("tie", F.lit("x")) \
        .withColumn("fp", F.lit(1))
    for given in (docs, docs.limit(0)):
        now = given
        for name, stage in corpus_pipeline.STAGES:
            rows, done = now.count(), stored(stage(spark, now, sf), "stage")
            if name != "packing":
                assert done.columns == list(corpus_pipeline.COLUMNS)
            if name in ("toxicity", "simhash near-dedup"):
                assert done.count() <= rows and done.exceptAll(now.select(*corpus_pipeline.COLUMNS)).count() == 0
            if name == "suffix-array dedup":
                assert done.count() == rows
            if rows and name == "simhash near-dedup":
                assert done.where("doc_id = 9009").count() == 1 and done.where("doc_id = 9010").count() == 1
            assert rows or not done.count()
            now = done


def test_mixed_rows_are_the_plain_mix(kept):
    """The words that stage 4 takes of each document, against plain loops over shards and blocks."""
    _, docs, done = kept[3]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    expected, _ = plain_mix(rows)
    taken = {}
    for r in done.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(mixing_words(r.text))
    assert taken == {i: n for i, _, n in expected if n}


def test_registered():
    assert [k for k in QUERIES if k.startswith("op")] and set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")) == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_twins(spark, sf, key):
    ok, detail = compare(spark, connect(sf), sf, key, QUERIES[key], ORACLES[key])
    assert ok, detail
