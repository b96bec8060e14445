"""Queries opN_<name>, one per operator, and `pipeline`, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweir.llm.workers import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    from clickweir.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_json())


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of each document."""
    from clickweir.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9 or more."""
    from clickweir.llm.embed_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    from clickweir.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and components of close ones."""
    from clickweir.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def crc_bucket(col: str, n: int):
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    from clickweir.llm.langid import identify

    docs = table(spark, sf_dir, "documents")
    held = crc_bucket("doc_id", 4) == 2
    return identify(docs, ~held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four fifths of the labels."""
    from clickweir.llm.quality_fm import score

    held = crc_bucket("doc_id", 5) == 0
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from clickweir.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labels."""
    from clickweir.llm.toxicity import score

    held = crc_bucket("doc_id", 5) == 0
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds marks, formatted and read back."""
    from clickweir.llm import chat_format as chat

    rows = chat.with_probe(table(spark, sf_dir, "conversations"))
    turns = chat.format_turns(rows.withColumn("parts", chat.text_parts(F.col("text"))))
    return chat.digests(chat.read_back(chat.format_conversations(turns)))


@query
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all conversations after planted damage, and the cheapest edits that repair their roles."""
    from clickweir.llm.turn_repair import damaged, repair, report

    return report(repair(*damaged(table(spark, sf_dir, "conversations"))))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of a byte-level BPE's and a piece model's tokens over all documents."""
    import public_tokenizers

    from clickweir.llm.token_align import align

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = f.read()
    return align(table(spark, sf_dir, "documents"), tokenizer_json(), pieces)


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to documents with smaller ids."""
    from clickweir.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES["op1_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 49)) AS p, h FROM d),
s AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM w),
f AS (SELECT s, min(doc_id) AS first_id FROM s GROUP BY s),
r AS (SELECT doc_id, p, p > 50 + lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) AS opens
      FROM s JOIN f USING (s) WHERE first_id < doc_id),
g AS (SELECT doc_id, p, sum(opens::int) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM r),
i AS (SELECT doc_id, span, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, span),
j AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM i),
k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM j JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed,
       coalesce(n_spans, 0)::bigint AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

ORACLES["op7_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
c AS (SELECT a AS vec_id, a AS seen FROM l UNION SELECT c.vec_id, l.b FROM c JOIN l ON c.seen = l.a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a),
m AS (SELECT vec_id, min(seen) AS least FROM c GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)"""

ORACLES["op11_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, p, '\1\\\2\3', 'g') AS name, regexp_replace(text, p, '\1\\\2\3', 'g') AS body
      FROM c, (SELECT '([<\[])(\\*)(/?s>|SYS\]|/?INST\]|/?ROLE\]|(?:image|audio|document):\d+>)' AS p)),
f AS (SELECT *, CASE role WHEN 'system' THEN '[SYS]' WHEN 'user' THEN '[INST]' WHEN 'assistant' THEN '[/INST]'
                ELSE '[ROLE]' || name || '[/ROLE]' END || body || '</s>' AS formatted FROM e),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted) AS lines,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '') AS loss,
             3 + sum(length(formatted))::bigint AS formatted_chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
