"""Exact-size stratified samples and splits.

Rows are ordered inside a stratum by a hash of their unique key and the seed. The
first `quota` rows in that order are the sample, found without sorting the stratum:
a histogram over the leading hash digits tells in which bucket the quota is reached;
rows of lower buckets are in, rows of higher ones out, and only that one bucket, a
millionth of the stratum, is ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickweir.operators.joins import broadcast_if_small
from clickweir.session import stored

BUCKET_DIGITS = 5  # hex digits: 16^5 buckets per stratum


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_hash", digest).withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))


def stratum_quotas(counts: DataFrame, strata: str, total: int | None = None,
                   fraction_pct: int | None = None) -> DataFrame:
    """Rows to take per stratum from its count `n`: proportional shares, largest
    remainders rounded up.

    One row per stratum. Give either the number of rows or a whole percent, of which
    the next whole number of rows is taken.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per stratum
    sizes = counts.withColumn("all_rows", F.sum("n").over(everything))
    if total is None:
        sizes = sizes.withColumn("want", F.expr(f"(all_rows * {int(fraction_pct)} + 99) div 100"))
    else:
        sizes = sizes.withColumn("want", F.least(F.lit(int(total)).cast("bigint"), F.col("all_rows")))
    shares = (sizes.withColumn("base", F.expr("(want * n) div all_rows"))
              .withColumn("rest", F.expr("(want * n) % all_rows")))
    by_rest = everything.orderBy(F.col("rest").desc(), F.col(strata).asc_nulls_last())
    left = F.col("want") - F.sum("base").over(everything)
    return shares.withColumn("left", left).withColumn("pos", F.row_number().over(by_rest)).select(
        strata, "n", (F.col("base") + (F.col("pos") <= F.col("left")).cast("int")).alias("quota"))


def stratified_flag(df: DataFrame, strata: str, key: str, seed: int = 42, total: int | None = None,
                    fraction_pct: int | None = None) -> DataFrame:
    """Add `sampled` (1 for the rows of the exact-size stratified sample).

    `key` must be unique, and `df` is read more than once: pass a stored table.
    """
    hashed = _hashed(df, key, seed)
    # stored, as it is used twice: at most one row per stratum and bucket
    histogram = stored(hashed.groupBy(strata, "_bucket").agg(F.count("*").alias("_n")), "histogram")
    counts = histogram.groupBy(strata).agg(F.sum("_n").alias("n"))
    quotas = stratum_quotas(counts, strata, total, fraction_pct)
    ordered = Window.partitionBy(strata).orderBy("_bucket")
    cumulative = histogram.withColumn("_upto", F.sum("_n").over(ordered))
    # the bucket in which each stratum reaches its quota, and how many rows it still gives
    cut = (cumulative.join(quotas, cumulative[strata].eqNullSafe(quotas[strata]))
           .where((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
           .select(cumulative[strata].alias("_stratum"), F.col("_bucket").alias("_cut"),
                   (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_take")))
    # one row per stratum; stored, so that its size is known
    marked = hashed.join(broadcast_if_small(stored(cut, "cut")), F.col(strata).eqNullSafe(F.col("_stratum")), "left")
    on_edge = F.col("_bucket") == F.col("_cut")
    lower = F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False))
    edge = marked.where(on_edge)
    # the rank is within the edge bucket only
    rank = F.row_number().over(Window.partitionBy(strata, "_bucket").orderBy("_hash", key))
    edge = edge.withColumn("sampled", (rank <= F.col("_take")).cast("int"))
    rest = marked.where(~F.coalesce(on_edge, F.lit(False))).withColumn("sampled", lower.cast("int"))
    return rest.unionByName(edge).select(*df.columns, "sampled")


def stratified_sample(df: DataFrame, strata: str, key: str, total: int, seed: int = 42) -> DataFrame:
    return stratified_flag(df, strata, key, seed, total=total).where("sampled = 1").drop("sampled")


def train_test_split(df: DataFrame, strata: str, key: str, test_pct: int = 20,
                     seed: int = 42) -> DataFrame:
    """Add `split` ('test' / 'train'), class shares kept, sizes exact."""
    flagged = stratified_flag(df, strata, key, seed, fraction_pct=test_pct)
    return flagged.withColumn("split", F.when(F.col("sampled") == 1, "test").otherwise("train")) \
        .drop("sampled")


def sample_ctr_check(source: DataFrame, samples: dict[str, DataFrame]) -> DataFrame:
    """Size and click rate of the source and of each sample."""
    from clickweir.functions.ratios import ctr_batch

    def rate(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(F.count("*").alias("n_rows"), F.sum(F.col("click")).alias("clicks"))
        return counts.select(F.lit(name).alias("name"), "n_rows",
                             ctr_batch(F.col("clicks"), F.col("n_rows")).alias("ctr"))

    out = rate("source", source)
    for name, sample in samples.items():
        out = out.unionByName(rate(name, sample))
    return out
