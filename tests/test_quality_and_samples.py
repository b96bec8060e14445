import hashlib
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickweir.catalog import QUERIES
from clickweir.operators import global_order, profiling, quality as q, sampling
from clickweir.plans import model_prep
from clickweir.plans.quality_suite import generic_checks, singular_checks
from conftest import rows


# --- quality --------------------------------------------------------------------

def test_clean_frames_give_no_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id int, click int")
    assert q.not_null(df, "id").count() == q.unique(df, "id").count() == 0
    assert q.accepted_values(df, "click", (0, 1)).count() == q.expression(df, "click <= 1").count() == 0
    assert q.unique_combination(df, ["id", "click"]).count() == 0
    assert q.relationships(df, "click", df.selectExpr("id - 1 AS p"), "p").count() == 0


def test_defects_are_found_exactly(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (None, 1), (None, None)], "id int, click int")
    assert q.not_null(df, "id").count() == 2
    assert rows(q.unique(df, "id")) == [(1, 2)]
    assert rows(q.accepted_values(df, "click", (0, 1))) == [(1, 5)]
    assert q.expression(df, "click <= 1").count() == 2
    assert rows(q.relationships(df, "click", df, "id")) and q.relationships(df, "click", df, "id").count() == 2


CHECKS = [q.check_not_null("t", "id"), q.check_unique("t", "id"), q.check_accepted("t", "click", (0, 1)),
          q.check_expression("t", "click", "click <= 1")]


def test_report_and_fail_fast(spark):
    bad = {"t": spark.createDataFrame([(1, 0), (1, 5), (2, 1)], "id int, click int")}
    got = {r["test"]: (r["seq"], r["failures"], r["status"]) for r in q.report(CHECKS, bad).collect()}
    assert got == {"not_null_t_id": (1, 0, "pass"), "unique_t_id": (2, 1, "fail"),
                   "accepted_values_t_click": (3, 1, "fail"), "expression_t_click": (4, 1, "fail")}
    fast = {r["seq"]: r["status"] for r in q.report(CHECKS, bad, fail_fast=True).collect()}
    assert fast == {1: "pass", 2: "fail", 3: "skipped", 4: "skipped"}
    good = {"t": spark.createDataFrame([(1, 0)], "id int, click int")}
    assert {r["status"] for r in q.report(CHECKS, good, fail_fast=True).collect()} == {"pass"}


def test_fail_fast_counts_skipped_checks(spark, sf):
    bad = {"t": spark.createDataFrame([(1, 0), (1, 5), (2, 1)], "id int, click int")}
    got = {r["seq"]: (r["failures"], r["status"]) for r in q.report(CHECKS, bad, fail_fast=True, count_skipped=True).collect()}
    assert got == {1: (0, "pass"), 2: (1, "fail"), 3: (1, "skipped"), 4: (1, "skipped")}
    report = QUERIES["dq_report_fail_fast"](spark, sf).collect()
    assert {r["status"] for r in report} == {"pass", "fail", "skipped"} and all(r["failures"] is not None for r in report)


def test_row_checks_share_one_scan(spark):
    df = {"t": spark.createDataFrame([(1, 0)], "id int, click int")}
    row_checks = [c for c in CHECKS if isinstance(c, q.RowCheck)]
    plan = q.report(row_checks, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_suite_sizes():
    assert len(singular_checks("2024-02-01")) == 17
    # 44 column checks less one relationship that compares a count with an id
    assert len(generic_checks(audited=True)) == 43
    names = [c.name for c in generic_checks(audited=True) + singular_checks("2024-02-01")]
    assert len(names) == len(set(names))


SEEDED = {  # check -> frames it must fail on
    "hourly_ctr_range": ("hourly", {"ctr_percentage": 101.0}),
    "hourly_clicks_lte_impressions": ("hourly", {"clicks_count": 11}),
    "hourly_has_data": ("hourly", {"total_impressions": 0}),
    "hourly_no_negative_values": ("hourly", {"total_clicks": -1}),
    "facts_ctr_range": ("facts", {"daily_ctr_percentage": None}),
    "facts_hours_valid": ("facts", {"hours_with_data": 25}),
    "facts_moving_avg_reasonable": ("facts", {"ctr_7day_moving_avg": -0.5}),
    "facts_reasonable_dod_change": ("facts", {"clicks_dod_pct_change": -1000.5}),
    "facts_no_negative_values": ("facts", {"daily_total_clicks": -1}),
    "facts_clicks_lte_impressions": ("facts", {"daily_total_clicks": 11}),
    "campaigns_valid_is_active": ("campaigns", {"is_active": None}),
    "staging_valid_click_values": ("staging", {"click": 3}),
}
GOOD = {
    "hourly": {"ctr_percentage": 10.0, "clicks_count": 1, "impressions_count": 10, "total_impressions": 10,
               "total_clicks": 1},
    "facts": {"daily_ctr_percentage": 10.0, "hours_with_data": 3, "ctr_7day_moving_avg": 10.0,
              "clicks_dod_pct_change": None, "daily_total_clicks": 1, "daily_total_impressions": 10},
    "campaigns": {"is_active": 1},
    "staging": {"click": 1},
}
TYPES = {"ctr_percentage": "double", "daily_ctr_percentage": "double", "ctr_7day_moving_avg": "double",
         "clicks_dod_pct_change": "double"}


@pytest.mark.parametrize("name", SEEDED)
def test_singular_checks_catch_their_defect(spark, name):
    table, defect = SEEDED[name]
    good = GOOD[table]
    schema = ", ".join(f"{c} {TYPES.get(c, 'int')}" for c in good)
    df = spark.createDataFrame([tuple(good.values()), tuple({**good, **defect}.values())], schema)
    check = next(c for c in singular_checks("2024-02-01") if c.name == name)
    assert q.violations(check, {table: df}).count() == 1


def test_schema_drift(spark):
    old = spark.createDataFrame([], "a int, b string, C long").schema
    new = spark.createDataFrame([(1, 2, None), (1, None, None)], "A int, b int, d string")
    assert rows(profiling.schema_drift_report(new, old)) == [
        ("b", "retyped", "string", "int", 1), ("c", "dropped", "bigint", None, 0), ("d", "added", None, "string", 0)]
    assert profiling.schema_drift_report(new, new.schema).count() == 0


# --- global order and profiles ----------------------------------------------------

def test_running_total_within_groups(spark):
    random.seed(5)
    data = [(random.choice("xyz"), i, random.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, v int, n int")
    got = {(r["g"], r["v"]): r["upto"] for r in
           global_order.running_total(df, [F.col("v")], F.col("n"), ["g"], "upto").collect()}
    sums = Counter()
    for g, v, n in sorted(data, key=lambda t: t[1]):
        sums[g] += n
        assert got[(g, v)] == sums[g]
    assert len(got) == len(data)


def test_positions_of_nulls_and_order(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert sorted(rows(global_order.surrogate_key(df, ["x"], "k")), key=lambda r: r[1]) == \
        [("a", 1), ("b", 2), (None, 3)]


def test_quantiles_and_profile(spark):
    random.seed(7)
    values = [random.randint(0, 30) for _ in range(501)]
    df = spark.createDataFrame([(v, None if v % 4 == 0 else v) for v in values], "v int, w int")
    got = {(r["column_name"], r["pct"]): r["value"] for r in
           profiling.exact_quantiles(df, ["v", "w"], (0, 25, 50, 75, 100)).collect()}
    cuts = statistics.quantiles(values, n=4, method="inclusive")
    assert [got[("v", p)] for p in (0, 25, 50, 75, 100)] == [min(values), *cuts, max(values)]
    kept = [v for v in values if v % 4]
    assert got[("w", 50)] == statistics.median(kept)
    profile = {r["column_name"]: r for r in profiling.profile_columns(df, ["v", "w"]).collect()}
    assert profile["w"]["n_nulls"] == len(values) - len(kept) and profile["w"]["n_distinct"] == len(set(kept))
    assert profile["v"]["data_type"] == "int"
    stats = {r["column_name"]: r for r in profiling.describe_numeric(df, ["v", "w"]).collect()}
    assert stats["v"]["mean"] == pytest.approx(statistics.mean(values))
    assert stats["w"]["std"] == pytest.approx(statistics.stdev(kept))
    top = profiling.top_values(df, "v", 3).collect()
    expected = sorted(Counter(map(str, values)).items(), key=lambda t: (-t[1], int(t[0])))[:3]
    assert [(str(r["value"]), r["n_rows"]) for r in top] == expected


# --- samples ------------------------------------------------------------------------

@pytest.mark.parametrize("total", [0, 1, 7, 100, 999, 1000, 5000])
def test_sample_is_exact_and_by_hash(spark, total):
    data = [(i, 1 if i % 6 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(data, "id int, click int")
    got = sampling.stratified_sample(df, "click", "id", total).collect()
    want = min(total, 1000)
    assert len(got) == want
    order = sorted((i for i, c in data if c == 1), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
    picked = sorted(r["id"] for r in got if r["click"] == 1)
    assert picked == sorted(order[: len(picked)])
    assert abs(len(picked) - want * len(order) / 1000) < 1


def test_sample_in_one_bucket(spark, monkeypatch):
    """The edge bucket alone decides when the histogram is too coarse to help."""
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    df = spark.range(5000).selectExpr("id", "cast(id % 2 as int) AS click")
    fine = sorted(r["id"] for r in sampling.stratified_sample(df, "click", "id", 777).collect())
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 5)
    assert sorted(r["id"] for r in sampling.stratified_sample(df, "click", "id", 777).collect()) == fine


def test_split_keeps_shares(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 5 = 0 as int) AS click")
    counts = Counter((r["split"], r["click"]) for r in sampling.train_test_split(df, "click", "id").collect())
    assert counts == {("test", 1): 40, ("test", 0): 160, ("train", 1): 160, ("train", 0): 640}
    other = sampling.stratified_sample(df, "click", "id", 100, seed=7)
    assert set(r["id"] for r in other.collect()) != set(
        r["id"] for r in sampling.stratified_sample(df, "click", "id", 100).collect())


def test_weights_and_labels(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (0, None), (1, "b")], "click int, x string")
    weights = {r["click"]: r["weight"] for r in model_prep.class_weights(df).collect()}
    assert weights == {0: 4 / (2 * 3), 1: 2.0}
    assert model_prep.with_class_weight(df).count() == 4
    codes = Counter(r["x"] for r in model_prep.label_encode(df, ["x"]).collect())
    assert codes == {0: 1, 1: 2, -1: 1}
    dictionary = model_prep.label_dictionary(df.where("x = 'b'"), ["x"])
    assert Counter(r["x"] for r in model_prep.label_encode(df, ["x"], dictionary).collect()) == {0: 2, -1: 2}


def test_models_learn_a_rule(spark):
    df = spark.range(600).selectExpr("id", "cast(id % 10 as int) AS a", "cast(id % 7 as int) AS b",
                                     "cast(id % 10 >= 7 as int) AS click")
    train = model_prep.with_class_weight(df)
    for model in (model_prep.logistic_regression(train, ["a", "b"]),
                  model_prep.random_forest(train, ["a", "b"], trees=5)):
        scored = model.transform(df)
        assert model_prep.auc(model_prep.with_score(scored)).first()["auc"] > 0.99
        report = {r["class"]: r for r in model_prep.confusion_report(scored).collect()}
        assert report[0]["actual"] == 420 and report[1]["actual"] == 180


def test_auc_counts_pairs(spark):
    random.seed(3)
    data = [(random.randint(0, 1), random.randint(0, 9) / 10) for _ in range(300)]
    wins = sum((a > b) + (a == b) / 2 for y, a in data for z, b in data if y == 1 and z == 0)
    n_pos = sum(y for y, _ in data)
    row = model_prep.auc(spark.createDataFrame(data, "click int, score double")).first()
    assert row["auc"] == pytest.approx(wins / (n_pos * (300 - n_pos)))
    one_class = model_prep.auc(spark.createDataFrame([(1, 0.5)], "click int, score double"))
    assert one_class.first()["auc"] is None


def test_confusion_numbers(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    report = {r["class"]: r for r in
              model_prep.confusion_report(spark.createDataFrame(pairs, "click int, prediction int")).collect()}
    one = report[1]
    assert (one["actual"], one["predicted"], one["hits"]) == (4, 5, 3)
    assert [float(one[c]) for c in ("precision_pct", "recall_pct", "f1_pct")] == [60.0, 75.0, 66.67]


def test_model_rows_are_staged_once(spark, sf, monkeypatch):
    """The dictionary and the split start from stored rows, and these are encoded behind the split, in one write."""
    from clickweir.catalog import exploration
    plans, real = [], model_prep.label_dictionary
    monkeypatch.setattr(model_prep, "label_dictionary", lambda df, columns: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, columns))
    written, stored = [], exploration.stored
    monkeypatch.setattr(exploration, "stored", lambda df, *label: written.append(stored(df, *label)) or written[-1])
    train, test = exploration._split_features(spark, sf)
    assert len(plans) == 1 and "Window" not in plans[0]
    assert len(written) == 2 and train.count() + test.count() == written[0].count()
    codes = {r["value"]: r["code"] for r in real(written[0], ["device_id"]).collect()}
    was = {r["id"]: r["device_id"] for r in written[0].collect()}
    assert all(r["device_id"] == codes[was[r["id"]]] for r in train.select("id", "device_id").union(test.select("id", "device_id")).collect())
