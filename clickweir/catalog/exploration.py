"""Exploration, sampling and model preparation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import ctr, ratio
from clickweir.operators import profiling, sampling
from clickweir.operators.windows import FIVE_MINUTES, ONE_MINUTE, breakdown_maps, merge_windows, tumbling_ctr
from clickweir.plans import exploration, model_prep
from clickweir.schema import ENCODED_COLUMNS, EVENT_COLUMNS, INT_COLUMNS, STRING_COLUMNS
from clickweir.session import scratch_path, stored
from clickweir.sources.tables import write_samples

_CLICKS = """CAST(sum(click) AS BIGINT) AS clicks, count(*) AS total, CAST(sum(click) AS DOUBLE) / count(*) AS ctr"""


@query("ctr_by_device", f"SELECT CAST(device_type AS BIGINT) AS device_type, {_CLICKS} FROM stg GROUP BY 1")
def _(spark, d):
    return exploration.ctr_by_device(frames.staged(spark, d, "click", "device_type"))


@query("ctr_by_banner", "SELECT CAST(banner_pos AS BIGINT) AS banner_pos, CAST(sum(click) AS DOUBLE) / count(*) AS ctr FROM stg GROUP BY 1")
def _(spark, d):
    return exploration.ctr_by_banner(frames.staged(spark, d, "click", "banner_pos"))


@query("click_distribution", """SELECT CAST(click AS BIGINT) AS click, count(*) AS n_rows,
CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM ad GROUP BY 1""")
def _(spark, d):
    return profiling.click_distribution(frames.ads(spark, d))


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


@query("profile_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
    f"count(DISTINCT {c}) AS n_distinct FROM ad" for c in EVENT_COLUMNS))
def _(spark, d):
    return profiling.profile_columns(frames.ads(spark, d), EVENT_COLUMNS).drop("data_type")


_MEASURES = INT_COLUMNS


@query("profile_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM ad" for c in _MEASURES))
def _(spark, d):
    stats = profiling.describe_numeric(frames.ads(spark, d), _MEASURES)
    return stats.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query("profile_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS BIGINT) AS pct, round(CAST(quantile_cont(CAST({c} AS DOUBLE), {p / 100}) AS DOUBLE), 6) AS value FROM ad"
    for c in _MEASURES for p in (25, 50, 75)))
def _(spark, d):
    return profiling.exact_quantiles(frames.ads(spark, d), _MEASURES) \
        .withColumn("value", F.round("value", 6))


@query("top_values", "SELECT device_id AS value, count(*) AS n_rows FROM ad GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, d):
    return profiling.top_values(frames.ads(spark, d), "device_id")


def _breakdown(key: str, minutes: int, width: str, dim: str) -> None:
    pair = "concat(dim, '=', printf('%.2f', rate / 100.0))"

    @query(key, f"""SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end,
CAST(sum(n) AS BIGINT) AS total_impressions, CAST(sum(c) AS BIGINT) AS total_clicks,
{ctr('CAST(sum(c) AS BIGINT)', 'CAST(sum(n) AS BIGINT)')} AS ctr, string_agg({pair}, ';' ORDER BY dim) AS breakdown
FROM (SELECT *, (40000 * c // 2 + n) // (2 * n) AS rate FROM (
  SELECT time_bucket(INTERVAL {minutes} MINUTE, event_time) AS window_start, CAST({dim} AS VARCHAR) AS dim,
         count(*) AS n, count(*) FILTER (click = 1) AS c FROM ad GROUP BY 1, 2)) GROUP BY 1""")
    def _(spark, d):
        return breakdown_text(breakdown_maps(frames.ads(spark, d), width, dim, "m"))


def breakdown_text(df):
    """The map as ordered text, for comparison."""
    entries = F.array_sort(F.map_entries("m"))
    text = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(9,2)").cast("string")))
    return df.withColumn("breakdown", F.array_join(text, ";")).drop("m")


_breakdown("breakdown_maps", 1, ONE_MINUTE, "site_category")
_breakdown("breakdown_maps_device", 5, FIVE_MINUTES, "device_type")

_M = "window_start, window_end, impressions, clicks, ctr"


@query("merge_accumulators", f"SELECT {_M} FROM m5")
def _(spark, d):
    """Five-minute metrics rolled up from one-minute ones."""
    return merge_windows(frames.metrics_1min(spark, d), FIVE_MINUTES)


@query("tumbling_ctr_batch", f"SELECT {_M} FROM m1")
def _(spark, d):
    """The streaming aggregate over stored events."""
    return tumbling_ctr(frames.ads(spark, d), ONE_MINUTE)


# --- samples ---------------------------------------------------------------------

def _ranked(total: str) -> str:
    """Rows with `sampled`, from the definition: rank by hash within the stratum."""
    return f"""SELECT *, CAST(rn <= quota AS BIGINT) AS sampled FROM (
  SELECT s.*, q.quota, row_number() OVER (PARTITION BY s.click
           ORDER BY md5(concat_ws(':', CAST(s.id AS VARCHAR), '42')), s.id) AS rn
  FROM stg s JOIN (
    SELECT click, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, click) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS quota
    FROM (SELECT click, want, want * n // al AS base, want * n % al AS rest
          FROM (SELECT click, n, al, {total} AS want FROM (
            SELECT click, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS al FROM stg GROUP BY click)))) q
  ON s.click = q.click)"""


def _labelled(spark, d):
    """Staged events, all columns."""
    return stored(frames.staged(spark, d))


_WIDE = ", ".join("CAST(id AS VARCHAR) AS id" if c == "id" else f"CAST({c} AS BIGINT) AS {c}" if c in INT_COLUMNS else c
                  for c in EVENT_COLUMNS if c != "hour") + \
    ", event_timestamp, CAST(event_date AS VARCHAR) AS event_date, event_hour"


@query("stratified_sample", f"SELECT {_WIDE} FROM ({_ranked('least(500, al)')}) WHERE sampled = 1")
def _(spark, d):
    """Exactly 500 rows, click shares kept."""
    return sampling.stratified_sample(_labelled(spark, d), "click", "id", 500)


def _sample_rate(name: str, total: str) -> str:
    return (f"SELECT '{name}' AS name, count(*) AS n_rows, {ratio('CAST(100 * sum(click) AS BIGINT)', 'count(*)')} AS ctr "
            f"FROM ({_ranked(total)}) WHERE sampled = 1")


SAMPLE_SIZES = {"s1000": 1000, "s10000": 10_000, "s50000": 50_000}    # all rows where there are fewer


@query("sample_ctr_check", " UNION ALL ".join(
    [f"SELECT 'source' AS name, count(*) AS n_rows, {ratio('CAST(100 * sum(click) AS BIGINT)', 'count(*)')} AS ctr FROM stg"]
    + [_sample_rate(name, f"least({n}, al)") for name, n in SAMPLE_SIZES.items()]))
def _(spark, d):
    rows = _labelled(spark, d)
    samples = {name: sampling.stratified_sample(rows, "click", "id", n) for name, n in SAMPLE_SIZES.items()}
    return sampling.sample_ctr_check(rows, samples)


@query("write_samples", " UNION ALL ".join(f"SELECT '{name}' AS name, {_WIDE} FROM ({_ranked(f'least({n}, al)')}) WHERE sampled = 1"
                                           for name, n in SAMPLE_SIZES.items()))
def _(spark, d):
    """Samples written as CSV, and all their rows read back."""
    rows, path = _labelled(spark, d), scratch_path(spark, "samples")
    samples = {name: sampling.stratified_sample(rows, "click", "id", n) for name, n in SAMPLE_SIZES.items()}
    write_samples(samples, path)
    back = [spark.read.schema(rows.schema).option("header", True).csv(f"{path}/{name}").withColumn("name", F.lit(name)) for name in samples]
    return reduce(DataFrame.unionByName, back)


@query("train_test_split_stratified", f"""SELECT {_WIDE},
CASE WHEN sampled = 1 THEN 'test' ELSE 'train' END AS split FROM ({_ranked('(20 * al + 99) // 100')})""")
def _(spark, d):
    return sampling.train_test_split(_labelled(spark, d), "click", "id")


@query("class_weights", """SELECT CAST(click AS BIGINT) AS click, count(*) AS n_rows,
CAST(sum(count(*)) OVER () AS DOUBLE) / CAST(count(*) OVER () * count(*) AS DOUBLE) AS weight FROM stg GROUP BY click""")
def _(spark, d):
    return model_prep.class_weights(frames.staged(spark, d, "click"))


_CODES = ", ".join(
    f"CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {_text(c)} NULLS LAST) - 1 END AS {c}"
    for c in ENCODED_COLUMNS)


@query("label_encode", f"SELECT CAST(id AS VARCHAR) AS id, event_time, {_CODES} FROM ad")
def _(spark, d):
    """Ten categorical columns as sorted-order codes."""
    return model_prep.label_encode(frames.ads(spark, d).select("id", "event_time", *ENCODED_COLUMNS))


# --- models: the twins state sizes, that a planted signal is found, and what the best fit implies ----

# the label, turned round in one row of ten: whoever learns it ranks 0.9 of the pairs right
SIGNAL = "CASE WHEN CAST(id AS BIGINT) % 10 = 0 THEN 1 - click ELSE click END"
FEATURES = (*STRING_COLUMNS, "hour_of_day", *model_prep.NUMERIC_FEATURES, "signal")
AUC_FLOOR = 0.8
BALANCED = 0.01     # share of the weight by which scores and labels of the best fit may differ


def _split_features(spark, d):
    rows = frames.staged(spark, d)
    rows = rows.withColumn("hour_of_day", F.hour("event_timestamp")).withColumn("signal", F.expr(SIGNAL))
    rows = stored(rows, "model-rows")      # for the dictionary and for the split
    dictionary = model_prep.label_dictionary(rows, STRING_COLUMNS)
    split = stored(model_prep.label_encode(sampling.train_test_split(rows, "click", "id"), STRING_COLUMNS, dictionary), "split-rows")
    train = model_prep.with_class_weight(split.where("split = 'train'"))
    return train, split.where("split = 'test'")


_MODEL = f"""SELECT '{{name}}' AS model, count(*) FILTER (sampled = 0) AS n_train, count(*) FILTER (sampled = 1 AND click = 1) AS n_pos,
count(*) FILTER (sampled = 1 AND click = 0) AS n_neg, {len(FEATURES)} AS n_features, 1 AS above_floor
FROM ({_ranked('(20 * al + 99) // 100')})"""


def _model_report(model, train, test, name):
    scored = model_prep.with_score(model.transform(test)).select("click", "score")
    # one row each
    n_train = train.agg(F.count("*").alias("n_train"))
    report = model_prep.auc(scored).withColumn("model", F.lit(name)).withColumn("n_features", F.lit(len(FEATURES)))
    return (n_train.withColumn("model", F.lit(name)).join(report, "model")
            .select("model", "n_train", "n_pos", "n_neg", "n_features", (F.col("auc") >= AUC_FLOOR).cast("int").alias("above_floor")))


@query("logistic_optimum", "SELECT 1 AS mean_fits, 1 AS signal_fits")
def _(spark, d):
    """At the optimum the weighted scores sum to the weighted labels, and so they do among the rows that have the signal."""
    train, _ = _split_features(spark, d)
    scored = model_prep.with_score(model_prep.logistic_regression(train, FEATURES).transform(train))
    rest = F.col("weight") * (F.col("score") - F.col("click"))
    return scored.agg((F.abs(F.sum(rest)) <= BALANCED * F.sum("weight")).cast("int").alias("mean_fits"),
                      (F.abs(F.sum(rest * F.col("signal"))) <= BALANCED * F.sum("weight")).cast("int").alias("signal_fits"))


@query("ctr_model_lr", _MODEL.replace("{name}", "logistic_regression"))
def _(spark, d):
    """Balanced logistic regression, judged on the test rows."""
    train, test = _split_features(spark, d)
    return _model_report(model_prep.logistic_regression(train, FEATURES), train, test, "logistic_regression")


@query("ctr_model_rf", _MODEL.replace("{name}", "random_forest"))
def _(spark, d):
    """Balanced forest of 100 trees."""
    train, test = _split_features(spark, d)
    return _model_report(model_prep.random_forest(train, FEATURES), train, test, "random_forest")


@query("forest_report", f"""SELECT class, count(*) FILTER (click = class) AS actual, 1 AS consistent
FROM ({_ranked('(20 * al + 99) // 100')}), (SELECT CAST(unnest([0, 1]) AS BIGINT) AS class) WHERE sampled = 1 GROUP BY 1""")
def _(spark, d):
    """Confusion report of the forest's own predictions: class sizes, and whether the counts agree and the signal is found."""
    train, test = _split_features(spark, d)
    scored = model_prep.random_forest(train, FEATURES).transform(test).select("click", "prediction")
    report = model_prep.confusion_report(scored)
    sound = (F.col("hits") <= F.least("actual", "predicted")) & (F.col("recall_pct") >= 80) & (F.col("precision_pct") >= 50)
    return report.select(F.col("class").cast("bigint").alias("class"), "actual", sound.cast("int").alias("consistent"))


@query("auc_report", """SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY c14 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
FROM (SELECT c14, count(*) FILTER (click = 1) AS pos, count(*) FILTER (click = 0) AS neg FROM stg GROUP BY 1))""")
def _(spark, d):
    """Area under the curve of one column taken as the score."""
    return model_prep.auc(frames.staged(spark, d, "click", "c14"), score="c14")


@query("confusion_report", f"""SELECT class, actual, predicted, hits, {ratio('(100 * hits)', 'predicted')} AS precision_pct,
{ratio('(100 * hits)', 'actual')} AS recall_pct, {ratio('(200 * hits)', '(actual + predicted)')} AS f1_pct
FROM (SELECT c.class, count(*) FILTER (click = c.class) AS actual, count(*) FILTER (pred = c.class) AS predicted,
  count(*) FILTER (click = c.class AND pred = c.class) AS hits
  FROM (SELECT click, CASE WHEN c18 >= 2 THEN 1 ELSE 0 END AS pred FROM stg) s,
       (SELECT CAST(unnest([0, 1]) AS BIGINT) AS class) c GROUP BY 1)""")
def _(spark, d):
    """Report of a fixed rule on c18, so that the twin can follow it."""
    rows = frames.staged(spark, d, "click", "c18")
    rule = F.when(F.col("c18") >= 2, 1).otherwise(0)
    return model_prep.confusion_report(rows.select("click", rule.alias("prediction")))
