"""Streams give what their batch twins give."""

import pytest

from lumenfold.plans.streams import stored
from lumenfold.streaming import events as E

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("make", [E.tumbling, E.sliding])
def test_windows(spark, make, tmp_path):
    out = E.run_to_memory(spark, make(E.event_stream(spark, DATA)), make.__name__, "complete", str(tmp_path))
    assert rows(out) == rows(make(stored(spark, DATA)))


def test_sessions_leave_only_the_open_tail(spark, tmp_path):
    got = rows(E.run_to_memory(spark, E.sessions(E.event_stream(spark, DATA)), "sessions", "append", str(tmp_path)))
    every = rows(E.sessions(stored(spark, DATA)))
    assert set(got) <= set(every) and len(every) - 20 < len(got)


def test_deduplicated(spark, tmp_path):
    out = E.run_to_memory(spark, E.deduplicated(E.event_stream(spark, DATA), ["user_id"]), "firsts", "append", str(tmp_path))
    assert out.count() == out.select("user_id").distinct().count() == stored(spark, DATA).select("user_id").distinct().count()


def test_interval_join(spark, tmp_path):
    views = E.event_stream(spark, DATA).where("event_type = 'view'")
    bought = E.event_stream(spark, DATA).where("event_type = 'purchase'")
    got = rows(E.run_to_memory(spark, E.interval_join(views, bought, "user_id", "6 HOURS"), "joined", "append", str(tmp_path)))
    batch = stored(spark, DATA)
    assert got and got == rows(E.interval_join(batch.where("event_type = 'view'"), batch.where("event_type = 'purchase'"), "user_id", "6 HOURS"))


def test_running_totals(spark, tmp_path):
    got = rows(E.run_to_memory(spark, E.running_totals(E.event_stream(spark, DATA)), "totals", "update", str(tmp_path)))
    assert got == rows(stored(spark, DATA).groupBy("user_id").agg({"event_id": "count", "value": "sum"}))


def test_late_events_are_dropped(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    source = tmp_path / "in"
    source.mkdir()
    batch = lambda *times: spark.createDataFrame([(i, t, 1, "view", 1.0) for i, t in enumerate(times)], "event_id long, t string, user_id long, event_type string, value double").selectExpr("event_id", "CAST(t AS timestamp) AS ts", "user_id", "event_type", "value")
    stream = E.tumbling(spark.readStream.schema(schema).parquet(str(source)))
    out = str(tmp_path / "out")
    for times in (("2024-01-01 00:10:00", "2024-01-01 05:00:00"), ("2024-01-01 00:20:00", "2024-01-01 09:00:00"), ("2024-01-01 12:00:00",)):
        batch(*times).write.mode("append").parquet(str(source))
        E.run_to_parquet(stream, out, str(tmp_path / "check"))
    got = {str(r["start"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01 00:00:00"] == 1 and got["2024-01-01 05:00:00"] == 1
