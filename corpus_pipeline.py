"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweir.llm import mixing, near_texts, packing, suffix_dedup, toxicity
from clickweir.llm.catalog import crc_bucket, table, tokenizer_json
from clickweir.llm.workers import ship_package
from clickweir.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None      # trained scores, components and draws are beyond SQL; tests/llm compares with plain versions


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay as they are, null texts among them."""
    ship_package(spark)
    learn = crc_bucket("doc_id", 5) != 0
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), learn, keep=COLUMNS[1:])
    return scored.filter(F.col("score") < 0.5).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: five-word shingles alike by 0.8 or more."""
    return near_texts.one_of_each(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, without the bytes that a smaller id has; n_chars is counted anew."""
    cut = suffix_dedup.remove_repeats(docs, with_text=True, keep=("lang", "source"))
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("bigint").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each time; n_chars is counted anew."""
    mixed = mixing.mixed_texts(docs.select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_json())


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats),
          ("mixing sources", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
