import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickweir.catalog import QUERIES, ingest as ingest_catalog
from clickweir.operators import validation as v
from clickweir.plans import ingest
from clickweir.schema import EVENT_COLUMNS, EVENT_SCHEMA, RAW_SCHEMA
from clickweir.sources import event_files as files
from clickweir.sources.tables import write_samples
from conftest import rows

VALID = dict(zip(EVENT_COLUMNS, (
    "1.4199688212321208e+19", "0", "14102101", "0", "12fb4121", "6b59f079", "f028772b", "ecad2386", "7801e8d9",
    "07d7df22", "a99f214a", "183586aa", "8bfcd3c6", "1", "0", "20970", "320", "50", "2372", "0", "813", "-1",
    "46", "100")))


def frame(spark, *changes):
    return spark.createDataFrame([tuple({**VALID, **c}[k] for k in EVENT_COLUMNS) for c in changes], RAW_SCHEMA)


def reason(spark, **change):
    return ingest.classify(frame(spark, change)).first()["reason"]


def test_valid_row(spark):
    row = ingest.classify(frame(spark, {})).first()
    assert row["reason"] is None
    assert row["id"] == 14199688212321208000 and row["c19"] == -1 and row["hour"] == 14102101


@pytest.mark.parametrize("change, expected", [
    ({"hour": "invalid"}, "type_error"), ({"click": ""}, "type_error"), ({"c14": "NaN"}, "type_error"),
    ({"c14": "inf"}, "type_error"), ({"c14": "1d"}, "type_error"), ({"id": "x"}, "type_error"),
    ({"click": None}, "missing_field"), ({"site_id": None}, "missing_field"),
    ({"click": "5"}, "invalid_click"), ({"click": "-1"}, "invalid_click"),
    ({"hour": "140102"}, "invalid_hour"), ({"hour": "2024122009"}, "invalid_hour"),
    ({"hour": "99999999"}, None), ({"hour": "10000000"}, None),
    ({"banner_pos": "10"}, "invalid_banner_pos"), ({"banner_pos": "7"}, None),
    ({"device_type": "10"}, "invalid_device_type"), ({"device_type": "5"}, None),
    ({"device_conn_type": "10"}, "invalid_device_conn_type"), ({"device_conn_type": "4"}, None),
    ({"device_conn_type": "5"}, "invalid_device_conn_type"), ({"site_id": ""}, None),
    ({"device_type": "phone", "hour": "2024122009"}, "type_error"),
    ({"click": "7", "banner_pos": "99"}, "invalid_click")])
def test_reasons(spark, change, expected):
    assert reason(spark, **change) == expected


def test_bounds_are_parameters(spark):
    wide = {"banner_pos": (0, 7), "device_type": (0, 5), "device_conn_type": (0, 5)}
    assert ingest.classify(frame(spark, {"device_conn_type": "5"}), wide).first()["reason"] is None


@pytest.mark.parametrize("text, number", [("1e+2", 100), ("3.9", 3), ("-3.9", -3), (" 5 ", 5), ("007", 7)])
def test_integers_go_through_double(spark, text, number):
    assert v.transform_types(frame(spark, {"c14": text})).first()["c14"] == number


def test_neighbouring_ids_stay_apart(spark):
    ids = ["10000009418151094273", "10000009418151094274"]
    typed = v.transform_types(frame(spark, *[{"id": i} for i in ids]))
    assert [str(r["id"]) for r in typed.collect()] == ids


def test_empty_strings_warn(spark):
    row = v.warn_empty_strings(v.transform_types(frame(spark, {"site_id": "", "app_id": ""}))).first()
    assert row["empty_fields"] == ["site_id", "app_id"]


def test_split_and_stats(spark):
    raw = frame(spark, {}, {"click": "5"}, {"hour": "invalid"}).withColumn(
        "line_number", F.monotonically_increasing_id())
    good, bad = ingest.split_valid_rejects(raw, "line_number")
    assert good.count() == 1 and good.columns == list(EVENT_COLUMNS)
    assert sorted(r["error"] for r in bad.collect()) == ["invalid_click", "type_error"]
    assert bad.columns == ["line_number", "raw_data", "error", "timestamp"]
    assert '"click":"5"' in bad.where("error = 'invalid_click'").first()["raw_data"]
    stats = ingest.ingest_stats(ingest.classify(raw), send_failed=1, duration_sec=2.0).first()
    assert (stats["total"], stats["success"], stats["validation_failed"], stats["send_failed"]) == (3, 1, 2, 1)
    assert float(stats["success_rate"]) == 33.33 and stats["rows_per_sec"] == 1.5


def test_observed_counters_match(spark):
    from pyspark.sql import Observation
    # its own session: one that holds an Observation can no longer ship ML models
    classified = ingest.classify(frame(spark.newSession(), {}, {"click": "5"}))
    seen = Observation("ingest")
    assert ingest.observe_ingest(classified, seen).count() == 2
    assert seen.get == {"total": 2, "success": 1, "validation_failed": 1}


def csv_text(*lines):
    return "\n".join([",".join(EVENT_COLUMNS), *lines]) + "\n"


def test_csv_plain_and_gzip(spark, tmp_path):
    lines = [",".join({**VALID, "id": f"1.{i}e+19", "click": str(i % 2)}.values()) for i in range(5)]
    (tmp_path / "plain.csv").write_text(csv_text(*lines))
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write(csv_text(*lines))
    for name in ("plain.csv", "packed.csv.gz"):
        df = files.scan_events_csv(spark, str(tmp_path / name))
        assert df.count() == 5
        assert ingest.valid_events(ingest.classify(df)).count() == 5


def test_csv_empty_and_short_lines(spark, tmp_path):
    empty = ",".join({**VALID, "site_id": "", "c14": ""}.values())
    path = tmp_path / "bad.csv"
    path.write_text(csv_text(empty, "1,0,14102101", ",".join(VALID.values()) + ",extra"))
    got = files.scan_events_csv(spark, str(path)).collect()
    assert got[0]["site_id"] == "" and got[0]["_corrupt_record"] is None
    assert got[1]["_corrupt_record"] == "1,0,14102101" and got[1]["site_id"] is None
    assert got[2]["_corrupt_record"].endswith(",extra")
    lenient = files.csv_null_lenient(spark, str(path), "feed").collect()
    assert lenient[0]["site_id"] is None and lenient[0]["c14"] is None and lenient[0]["hour"] == 14102101
    assert lenient[0]["_source"] == "feed" and lenient[1]["_corrupt_record"] is not None


def test_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    for f in range(3):
        lines = [",".join({**VALID, "id": str(100 * f + i), "site_id": "s" * i}.values()) for i in range(40 - 10 * f)]
        (tmp_path / f"part-{f}.csv").write_text(csv_text(*lines))
    (tmp_path / "part-3.csv").write_text(csv_text())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        numbered = files.csv_numbered_lines(spark, str(tmp_path), "feed")
        assert files.csv_null_lenient(spark, str(tmp_path), "feed").select(F.spark_partition_id()).distinct().count() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert numbered.columns == files.csv_null_lenient(spark, str(tmp_path), "feed").columns
    got = sorted((r["_line_number"], int(r["id"])) for r in numbered.collect())
    assert got == list(enumerate([*range(40), *range(100, 130), *range(200, 220)], 1))


def test_lenient_copy_is_written_by_many_tasks(spark, sf, monkeypatch):
    written = []
    copy = ingest_catalog.frames.csv_copy
    monkeypatch.setattr(ingest_catalog.frames, "csv_copy", lambda spark, rows: written.append(rows) or copy(spark, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = [r["line"] for r in QUERIES["csv_null_lenient"](spark, sf).collect()]
        assert written[0].select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(lines) == list(range(1, len(lines) + 1))


def test_scan_limit(spark):
    df = spark.range(10)
    assert files.scan_limit(df, 3, [F.col("id").desc()]).count() == 3
    assert files.scan_limit(df, None).count() == files.scan_limit(df, 0).count() == 10


def test_json_round_trip_and_modes(spark):
    good = ingest.valid_events(ingest.classify(frame(spark, {}, {"site_id": "광고 \"x\""})))
    messages = files.publish_event_json(good)
    assert messages.columns == ["key", "value"]
    back = files.parse_event_json(messages, on_error="fail").select(*EVENT_SCHEMA.names)
    assert sorted(rows(back)) == sorted(rows(good))
    broken = spark.createDataFrame([("k", '{"id": 1'), ("n", None)], "key string, value string")
    mixed = messages.unionByName(broken)
    assert files.parse_event_json(mixed, on_error="drop").count() == 2
    dead = files.parse_event_json(mixed).where("_corrupt_record IS NOT NULL")
    assert sorted(r["_corrupt_record"] for r in dead.collect()) == ["", '{"id": 1']
    with pytest.raises(PySparkException, match="undecodable event"):
        files.parse_event_json(mixed, on_error="fail").collect()
    with pytest.raises(ValueError):
        files.parse_event_json(mixed, on_error="ignore")


def test_write_samples(spark, tmp_path):
    write_samples({"a": spark.range(3)}, str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "a")).count() == 3
