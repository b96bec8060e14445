import json

from pyspark.sql import functions as F

from clickweir.catalog import QUERIES
from clickweir.plans import faults
from clickweir.sources import tables
from conftest import rows

def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def message(**extra):
    return json.dumps({"id": 1, "click": 0, "hour": 14102101, "banner_pos": 0, "site_id": "s", **extra})


def route(spark, *texts, **kwargs):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return faults.retry_router(faults.retry_decode(df), now=now(), **kwargs)


def test_router_by_count(spark):
    got = route(spark, *[message(retry_count=n) for n in range(5)]).orderBy("retry_count").collect()
    assert [r["action"] for r in got] == ["retry", "retry", "dlq", "dlq", "dlq"]
    assert [r["backoff_ms"] for r in got] == [1000, 2000, None, None, None]
    assert [r["reason"] for r in got] == [None, None, *[f"Max retries exceeded ({n})" for n in (3, 4, 5)]]
    assert (got[1]["next_attempt_at"] - got[0]["next_attempt_at"]).total_seconds() == 1


def test_more_attempts_follow_the_cap(spark):
    got = route(spark, *[message(retry_count=n) for n in range(7)], max_attempts=10).orderBy("retry_count")
    assert [r["backoff_ms"] for r in got.collect()] == [1000, 2000, 4000, 8000, 16000, 32000, 32000]


def test_missing_count_is_a_first_attempt(spark):
    row = route(spark, message()).first()
    assert (row["next_retry_count"], row["action"], row["backoff_ms"]) == (1, "retry", 1000)


def test_undecodable_goes_to_the_dead_letters(spark):
    routed = route(spark, '{"id": 1, "cl', message(retry_count=2))
    letters = sorted((json.loads(r["value"]) for r in faults.retry_decode_dlq(routed, now()).collect()),
                     key=lambda m: m["reason"])
    assert letters[0]["original_message"] == {"raw_value": '{"id": 1, "cl'}
    assert letters[0]["reason"].startswith("JSON decode error: ")
    assert letters[1]["original_message"]["retry_count"] == 2
    assert letters[1]["reason"] == "Max retries exceeded (3)"
    assert set(letters[1]) == {"original_message", "sent_to_dlq_at", "reason"}
    stats = faults.retry_stats(routed).first()
    assert (stats["total"], stats["processed"], stats["retried"], stats["dlq_sent"], stats["errors"]) == (2, 1, 0, 2, 1)


def test_any_object_is_decoded(spark):
    got = route(spark, '{"id":"msg-1","retry_count":0,"error":"Timeout"}', '{"id":1,"click":"x","retry_count":0}',
                '{"id":{"a":1},"error_history":["e", 2]}', '[1]', '"text"', "null").collect()
    assert [(r["id"], r["click"], r["action"]) for r in got] == [
        ("msg-1", None, "retry"), ("1", None, "retry"), ('{"a":1}', None, "retry"), *[(None, None, "dlq")] * 3]
    assert got[2]["error_history"] == ["e", "2"]


def letters(spark, *values):
    data = [(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), "dlq", 0, i)
            for i, v in enumerate(values)]
    return faults.dlq_parse(spark.createDataFrame(data, "value string, topic string, partition int, offset bigint"))


def test_parse_defaults(spark):
    got = letters(spark, {"original_message": {"id": 7}, "reason": "r", "sent_to_dlq_at": "t"}, {"reason": "r"}, {},
                  {"original_message": {"id": "a b'\"\\ 광고"}, "reason": 'x "y"'}, "not json").orderBy("offset").collect()
    assert [r["message_id"] for r in got] == ["7", "unknown", "unknown", "a b'\"\\ 광고", None]
    assert [r["reason"] for r in got] == ["r", "r", "Unknown reason", 'x "y"', None]
    assert got[4]["_corrupt_record"] == "not json"


def test_store_replay_and_log(spark, tmp_path):
    parsed = letters(spark, {"original_message": {"id": 7}, "reason": "r"}, {}, "not json")
    stored = faults.dlq_rows(parsed, now())
    for _ in range(2):
        tables.store_dlq_messages(stored, str(tmp_path / "t"), 4, run="a")
    back = spark.read.option("basePath", str(tmp_path / "t")).parquet(str(tmp_path / "t"))
    assert back.count() == 2 and back.first()["batch_id"] == 4
    for _ in range(2):
        tables.dlq_daily_log(stored, str(tmp_path / "log"), 0, run="a")
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    assert (tmp_path / "log" / "log_date=2024-01-01").exists()
    stats = faults.dlq_stats(parsed, 1000).first()
    assert (stats["received"], stats["stored"], stats["errors"], float(stats["dlq_rate_pct"])) == (3, 2, 1, 0.3)
    assert faults.dlq_alert_rows(parsed).count() == 2


def test_eligibility_and_replay(spark):
    df = spark.createDataFrame([("Timeout after 3s", 0), ("Timeout", 3), ("bad", 0), (None, 0),
                                ("x Connection error y", None)], "error string, retry_count int")
    assert [r["eligible"] for r in faults.retry_eligibility(df).collect()] == [1, 0, 0, 0, 1]
    stored = faults.dlq_rows(letters(
        spark, {"original_message": {"id": 1, "retry_count": 1, "x": [1]}, "reason": "Timeout"},
        {"original_message": {"id": 2, "retry_count": 3}, "reason": "Timeout"},
        {"original_message": {"id": 3}, "reason": "Schema mismatch"}), now())
    got = rows(faults.dlq_replay(stored))
    assert [k for k, _ in got] == ["1"] and json.loads(got[0][1]) == {"id": 1, "retry_count": 1, "x": [1]}


def test_recovered_and_history(spark):
    raw = spark.createDataFrame([(1,)], "id int")
    back = spark.createDataFrame([(2, 2)], "id int, retry_count int")
    both = faults.retry_recovered(raw, back).select("id", "retry_count", "was_retried")
    assert sorted(rows(both)) == [(1, None, None), (2, 2, True)]
    df = spark.createDataFrame([(["Connection refused"],), (None,)], "error_history array<string>")
    got = faults.retry_error_history(df, F.lit("Connection timeout")).collect()
    assert got[0]["error_history"] == ["Connection refused", "Connection timeout"]
    assert got[1]["error_history"] == ["Connection timeout"] and got[1]["last_error"] == "Connection timeout"


def test_a_replayed_log_decodes_once(spark, sf, monkeypatch):
    """Both writes of the batch, the replay too, read the stored dead letters."""
    logged = []
    write = tables.dlq_daily_log
    monkeypatch.setattr(tables, "dlq_daily_log", lambda rows, *a, **k: logged.append(rows) or write(rows, *a, **k))
    assert QUERIES["dlq_daily_log"](spark, sf).count() > 0
    plans = [rows._jdf.queryExecution().optimizedPlan().toString() for rows in logged]
    assert len(plans) == 2 and not any("parse_json" in p or "from_json" in p.lower() for p in plans)
