"""Retry rounds: every message ends once, and a repeated round changes nothing."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickweir.plans import retry_loop as loop

NOW = datetime(2024, 2, 1)
LIMITS = {"max_attempts": 5, "base_ms": 30_000, "cap_ms": 200_000}


def failed(spark, n, first=0):
    return spark.createDataFrame([(f"k{i}", i % 3, f"p{i}", ["e"]) for i in range(first, first + n)],
                                 "key string, retry_count int, payload string, errors array<string>")


def recovers(due):
    return (F.substr("key", F.lit(2)).cast("int") + F.col("retry_count")) % 5 == 0


def plain(n, first=0):
    out = {}
    for i in range(first, first + n):
        count = i % 3 + 1
        while count < 5 and (i + count) % 5:
            count += 1
        out[f"k{i}"] = ("recovered", count) if count < 5 else ("dead", 4)
    return out


def ends(spark, root):
    rows = loop.ended(spark, root).collect()
    assert len({r["key"] for r in rows}) == len(rows)
    return {r["key"]: (r["outcome"], r["attempts"]) for r in rows}


def test_all_messages_end_once(spark, tmp_path):
    root = str(tmp_path)
    loop.enqueue(failed(spark, 60), root, "a", NOW, **LIMITS)
    assert loop.drain(spark, root, recovers, **LIMITS) > 2
    assert ends(spark, root) == plain(60) and loop.next_minute(spark, root) is None
    dead = loop.ended(spark, root).where("outcome = 'dead'").first()
    assert dead["reason"] == "Max retries exceeded (5)" and dead["errors"][-1] == "retry failed"


@pytest.mark.parametrize("lost", ["done", "dead", "waiting"])
def test_a_round_cut_short_or_repeated(spark, tmp_path, monkeypatch, lost):
    root, real = str(tmp_path), loop._write
    loop.enqueue(failed(spark, 30), root, "a", NOW, **LIMITS)
    minute = loop.next_minute(spark, root)

    def cut(rows, path, by):
        if path.endswith(lost):
            raise OSError("lost")
        real(rows, path, by)
    if lost == "done":
        loop.run_round(spark, root, minute, recovers, **LIMITS)
    else:
        monkeypatch.setattr(loop, "_write", cut)
        with pytest.raises(OSError):
            loop.run_round(spark, root, minute, recovers, **LIMITS)
        monkeypatch.setattr(loop, "_write", real)
    loop.enqueue(failed(spark, 30), root, "a", NOW, **LIMITS) if lost != "done" else None
    loop.run_round(spark, root, minute, recovers, **LIMITS)
    loop.drain(spark, root, recovers, **LIMITS)
    assert ends(spark, root) == plain(30)


def test_later_messages_wait_for_a_later_minute_and_other_folders_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    loop.enqueue(failed(spark, 10), root, "a", NOW, **LIMITS)
    first = loop.next_minute(spark, root)
    loop.run_round(spark, root, first, recovers, **LIMITS)
    loop.enqueue(failed(spark, 10, first=100), root, "b", NOW, **LIMITS)     # their minute is over
    assert loop.next_minute(spark, root) > first
    with open(os.path.join(root, "waiting", f"due_minute={first}", "broken.parquet"), "w") as f:
        f.write("no parquet file")          # an old folder
    loop.drain(spark, root, recovers, **LIMITS)
    assert ends(spark, root) == plain(10) | plain(10, first=100)
    assert loop.drain(spark, root, recovers, **LIMITS) == 0
