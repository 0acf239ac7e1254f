"""Streams over many files: late events, a stop before a commit, a restart, timers and expiring state."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenfold.plans.streams import stored
from lumenfold.streaming import events as E
from lumenfold.streaming import replay, stateful

DATA = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def made(spark, rows):
    """Rows of (minutes, user, kind); the id is the order."""
    return spark.createDataFrame([(i, START + timedelta(minutes=m), u, k, 1.0) for i, (m, u, k) in enumerate(rows)], SCHEMA)


def test_files_come_in_order_of_arrival(spark, tmp_path):
    events = stored(spark, DATA)
    replay.write_in_order(spark, events, F.col("ts"), f"{tmp_path}/in", 8)
    stream = replay.file_stream(spark, f"{tmp_path}/in", events.schema, 2)
    assert replay.run_batches(stream, str(tmp_path / "out"), "append") == [0, 1, 2, 3]
    spans = spark.read.parquet(f"{tmp_path}/out/rows").groupBy("batch").agg(F.min("ts"), F.max("ts"), F.count("*")).orderBy("batch").collect()
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:])) and sum(r[3] for r in spans) == events.count()


def test_a_stopped_batch_is_run_again_and_replaces_itself(spark, tmp_path):
    events = stored(spark, DATA)
    replay.write_in_order(spark, events, F.col("ts"), f"{tmp_path}/in", 8)
    stream = replay.file_stream(spark, f"{tmp_path}/in", events.schema, 1)
    got = replay.run_with_restart(spark, stream, str(tmp_path / "out"), "append", stop_in=3)
    assert got.count() == events.count() == got.select("event_id").distinct().count()
    with pytest.raises(RuntimeError):  # nothing is left to run, so nothing was stopped
        replay.run_with_restart(spark, stream, str(tmp_path / "out"), "append", stop_in=3)


def test_too_late_events_are_left_out(spark, tmp_path):
    events = stored(spark, DATA)
    replay.write_in_order(spark, events, replay.delayed(events, 72), f"{tmp_path}/in", 12)
    stream = E.tumbling(replay.file_stream(spark, f"{tmp_path}/in", events.schema, 2), late="10 minutes")
    out = replay.run_with_restart(spark, stream, str(tmp_path / "out"), "append", stop_in=2, least=5)
    late = events.where(F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0).count()
    n = out.agg(F.sum("n")).first()[0]
    assert events.count() - late - 20 <= n < events.count()


def sessions(spark, tmp_path, arrivals, late="60 minutes"):
    """Batches of rows, one file each, through Sessions."""
    source = tmp_path / "in"
    for i, rows in enumerate(arrivals):
        made(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
        time.sleep(0.02)
        stream = stateful.timed_sessions(spark.readStream.schema(SCHEMA).parquet(str(source)), 1800, late)
        with stateful.rocksdb(spark):
            replay.run_batches(stream, str(tmp_path / "out"), "append")
    rows = spark.read.parquet(str(tmp_path / "out/rows")).collect()
    minutes = lambda t: int((t - START).total_seconds() // 60)
    return sorted((r["user_id"], minutes(r["start"]), minutes(r["end"]), r["n"], r["kinds"], r["views"]) for r in rows)


def test_late_events_merge_open_sessions(spark, tmp_path):
    got = sessions(spark, tmp_path, [[(0, 1, "view"), (50, 1, "click"), (55, 2, "view")], [(25, 1, "view"), (90, 3, "x")], [(400, 9, "end")], [(900, 9, "end")]])
    assert got == [(1, 0, 80, 3, 2, 2), (2, 55, 85, 1, 1, 1), (3, 90, 120, 1, 1, 0), (9, 400, 430, 1, 1, 0)]


def test_views_are_summed_over_closed_sessions(spark, tmp_path):
    got = sessions(spark, tmp_path, [[(0, 1, "view"), (10, 1, "view")], [(300, 1, "view"), (310, 2, "a")], [(700, 1, "a")], [(1200, 5, "end")]])
    assert got == [(1, 0, 40, 2, 1, 2), (1, 300, 330, 1, 1, 3), (1, 700, 730, 1, 1, 3), (2, 310, 340, 1, 1, 0)]


def test_state_expires(spark, tmp_path):
    def run(ttl, name, pause):
        source = tmp_path / name
        for _ in range(2):
            made(spark, [(0, 1, "a"), (1, 1, "b"), (2, 1, "a")]).coalesce(1).write.mode("append").parquet(str(source))
            stream = stateful.first_seen(spark.readStream.schema(SCHEMA).parquet(str(source)), ttl)
            with stateful.rocksdb(spark):
                replay.run_batches(stream, str(tmp_path / f"{name}-out"), "append", endless=True)
            time.sleep(pause)
        return spark.read.parquet(str(tmp_path / f"{name}-out/rows")).count()

    assert run(3_600_000, "kept", 0) == 2
    assert run(500, "forgotten", 1.5) == 4
    provider = spark.conf.get(stateful.PROVIDER)
    assert "RocksDB" not in provider
