"""Features, class weights, encodings and click models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from clickweir.functions.ratios import ratio_2dp
from clickweir.operators.global_order import running_total
from clickweir.operators.joins import BROADCAST_BYTES, broadcast_if_small, estimated_bytes
from clickweir.schema import ENCODED_COLUMNS, INT_COLUMNS
from clickweir.session import stored

HEAVY_VALUES = 1000      # parts of a column; values that hold one or more are few
NUMERIC_FEATURES = tuple(c for c in INT_COLUMNS if c not in ("click", "hour"))


def class_weights(df: DataFrame, label: str = "click") -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    all_classes = Window.partitionBy(F.lit(0))  # one row per class
    total, k = F.sum("n_rows").over(all_classes), F.count("*").over(all_classes)
    return counts.withColumn("weight", total / (k * F.col("n_rows")))


def with_class_weight(df: DataFrame, label: str = "click") -> DataFrame:
    weights = stored(class_weights(df, label).select(label, "weight"), "weights")
    return df.join(broadcast_if_small(weights), label)


def label_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, code): codes 0, 1, ... in sorted order of the values as text.

    All columns share one distinct pass and one global ordering; the dictionaries stay
    distributed, however many devices or addresses there are.
    """
    cells = df.select([F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([], list(columns), "column_name", "value").where(F.col("value").isNotNull()).distinct()
    coded = running_total(cells, [F.col("value").asc()], within=["column_name"], alias="code")
    return stored(coded.withColumn("code", F.col("code") - 1), "labels")


def label_encode(df: DataFrame, columns: Sequence[str] = ENCODED_COLUMNS, dictionary: DataFrame | None = None,
                 max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace columns by their codes; values not in the dictionary (and NULL) get -1.

    A dictionary of up to `max_bytes` is broadcast, column by column. With a larger one, the values that hold at least one
    HEAVY_VALUES-th of a column's rows, so at most so many, are broadcast. Only the other cells, as
    row, column and value, are shuffled: once to their codes and once back to their rows.
    """
    if dictionary is None:
        dictionary = label_dictionary(df, columns)
    if estimated_bytes(dictionary) <= max_bytes:
        return _with_codes(df, columns, dictionary, -1)
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "encoded-rows")
    cells = rows.select("_row", *[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot(["_row"], list(columns), "column_name", "value").where(F.col("value").isNotNull())
    per_value = cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    heavy = stored(per_value.where(F.col("n") * HEAVY_VALUES >= rows.count()), "heavy-values")
    few = stored(dictionary.join(F.broadcast(heavy.drop("n")), ["column_name", "value"]), "heavy-codes")    # HEAVY_VALUES per column at most
    light = cells.join(F.broadcast(few), ["column_name", "value"], "left_anti").join(dictionary, ["column_name", "value"])
    codes = light.groupBy("_row").agg(*[F.max(F.when(F.col("column_name") == c, F.col("code"))).alias(f"_light_{c}") for c in columns])
    out = _with_codes(rows, columns, few, None).join(codes, "_row", "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_light_{c}"), F.lit(-1)).alias(c) if c in columns else F.col(c) for c in df.columns])


def _with_codes(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, unknown: int | None) -> DataFrame:
    """Codes by broadcast of the dictionary, which is known to be small."""
    out = df
    for c in columns:
        codes = dictionary.where(F.col("column_name") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = out.join(F.broadcast(codes), F.col(c).cast("string") == F.col(f"_v_{c}"), "left") \
            .withColumn(c, F.coalesce(F.col(f"_c_{c}"), F.lit(unknown).cast("bigint"))).drop(f"_v_{c}", f"_c_{c}")
    return out


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def logistic_regression(train: DataFrame, features: Sequence[str], label: str = "click") -> PipelineModel:
    """Balanced logistic regression; `train` carries a `weight` column."""
    model = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=100)
    return Pipeline(stages=[assembler(features), model]).fit(train)


def random_forest(train: DataFrame, features: Sequence[str], label: str = "click",
                  trees: int = 100, seed: int = 42) -> PipelineModel:
    model = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight",
                                   numTrees=trees, seed=seed)
    return Pipeline(stages=[assembler(features), model]).fit(train)


def with_score(scored: DataFrame) -> DataFrame:
    """Probability of a click as a plain column."""
    return scored.withColumn("score", vector_to_array("probability")[1])


def auc(scored: DataFrame, label: str = "click", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve: the share of (click, non-click) pairs in which the
    click scores higher, ties counted half.

    Rows merge to one per score; the non-clicks below each score come from a running
    total, so no pair is formed and no task sees all scores. Products are exact decimals.
    """
    per_score = scored.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                          F.count_if(F.col(label) == 0).alias("neg"))
    ranked = running_total(per_score, [F.col(score).asc()], F.col("neg"), alias="upto")
    pos, neg, wide = F.col("pos").cast("decimal(18,0)"), F.col("neg"), "decimal(19,0)"
    wins = pos * ((F.col("upto") - neg) * 2 + neg).cast(wide)
    totals = ranked.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
                        F.sum(wins).cast("double").alias("wins"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return totals.select("n_pos", "n_neg", F.try_divide(F.col("wins"), pairs * 2).alias("auc"))


def confusion_report(scored: DataFrame, label: str = "click", prediction: str = "prediction") -> DataFrame:
    """Confusion counts with precision, recall and F1 (percent, 2 dp), one row per class."""
    cells = scored.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")) \
        .agg(F.count("*").alias("n"))
    # at most one row per pair of classes
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")))).alias("s")).select("s.*")
    totals = sides.groupBy("class").agg(F.sum("actual").alias("actual"),
                                        F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    hits = F.col("hits") * 100
    return totals.select(
        "class", "actual", "predicted", "hits",
        ratio_2dp(hits, F.col("predicted")).alias("precision_pct"),
        ratio_2dp(hits, F.col("actual")).alias("recall_pct"),
        ratio_2dp(hits * 2, F.col("actual") + F.col("predicted")).alias("f1_pct"))
