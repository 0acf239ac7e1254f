"""Streaming queries: the events as an available-now stream of files, run into Parquet and read back.

What the watermark has not passed at the end is not emitted: the oracles leave out the same open tail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.plans.registry import query
from lumenfold.sources.tables import scratch_path, table
from lumenfold.streaming import events as E
from lumenfold.streaming import replay, stateful


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df: DataFrame) -> DataFrame:
    """Times without zone, as the oracle has them, and sums to the cent."""
    times = [c for c, t in df.dtypes if t == "timestamp"]
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    return df.withColumn("total", F.round("total", 2)) if "total" in df.columns else df


def run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    return plain(E.run_through_files(spark, stream, scratch_path(spark, name)))


CLOSED = "(SELECT max(ts) - INTERVAL '10 minutes' FROM events)"


@query("st1_tumbling", f"SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY date_trunc('hour', ts), event_type HAVING start + INTERVAL '1 hour' <= {CLOSED}")
def st1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, E.tumbling(E.event_stream(spark, sf_dir)), "st1")


@query("st2_sliding", f"""
SELECT start, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS start FROM events)
GROUP BY start, event_type HAVING start + INTERVAL '1 hour' <= {CLOSED}
""")
def st2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, E.sliding(E.event_stream(spark, sf_dir)), "st2")


@query("st3_sessions", f"""
WITH marked AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS fresh FROM events),
numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", count(*) AS n FROM numbered GROUP BY user_id, s HAVING max(ts) + INTERVAL '30 minutes' <= {CLOSED}
""")
def st3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, E.sessions(E.event_stream(spark, sf_dir)), "st3")


@query("st4_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def st4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark trails by more than the table's month, so no key is met anew."""
    firsts = E.deduplicated(E.event_stream(spark, sf_dir), ["user_id", "event_type"], "60 days")
    return run(spark, firsts.select("user_id", "event_type"), "st4")


@query("st5_running_state", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def st5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last state of all batches."""
    states = E.run_updates(spark, E.running_totals(E.event_stream(spark, sf_dir)), scratch_path(spark, "st5"))
    last = states.groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "batch").alias("s"))
    return plain(last.select("user_id", "s.n", "s.total"))


@query("st6_interval_join", """
SELECT v.user_id AS key, v.event_id AS left_id, p.event_id AS right_id
FROM events v JOIN events p ON v.user_id = p.user_id AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL '1 hour'
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def st6(spark: SparkSession, sf_dir: str) -> DataFrame:
    views, bought = (E.event_stream(spark, sf_dir).where(F.col("event_type") == k) for k in ("view", "purchase"))
    return run(spark, E.interval_join(views, bought, "user_id", "1 HOUR"), "st6")


#: Files that the events are replayed from, files of a batch, the batch that is stopped before its commit,
#: hours that late events are late, and the watermark's delay.
FILES, FILES_A_BATCH, STOP_IN, LATE_HOURS, DELAY = 24, 3, 3, 36, "48 hours"
CLOSED_LATE = "(SELECT max(ts) - INTERVAL '48 hours' FROM events)"


def arriving(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The events as a stream of many files, a tenth of them late."""
    rows = stored(spark, sf_dir)
    replay.write_in_order(spark, rows, replay.delayed(rows, LATE_HOURS), f"{path}/in", FILES)
    return replay.file_stream(spark, f"{path}/in", rows.schema, FILES_A_BATCH)


def restarted(spark: SparkSession, sf_dir: str, name: str, make, mode: str = "append", endless: bool = False) -> DataFrame:
    path = scratch_path(spark, name)
    return replay.run_with_restart(spark, make(arriving(spark, sf_dir, path)), path, mode, STOP_IN, endless=endless)


@query("st1_restarted", f"SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY date_trunc('hour', ts), event_type HAVING start + INTERVAL '1 hour' <= {CLOSED_LATE}")
def st1_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over nine batches, with late files, a stop in the middle and a restart."""
    return plain(restarted(spark, sf_dir, "st1r", lambda s: E.tumbling(s, late=DELAY)).drop("batch"))


@query("st3_restarted", f"""
WITH marked AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS fresh FROM events),
numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", count(*) AS n FROM numbered GROUP BY user_id, s HAVING max(ts) + INTERVAL '30 minutes' <= {CLOSED_LATE}
""")
def st3_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that late files extend and merge, over a restart."""
    return plain(restarted(spark, sf_dir, "st3r", lambda s: E.sessions(s, late=DELAY)).drop("batch"))


@query("st5_restarted", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def st5_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals whose state is carried over a restart: each user's last."""
    states = restarted(spark, sf_dir, "st5r", E.running_totals, "update")
    last = states.groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "batch").alias("s"))
    return plain(last.select("user_id", "s.n", "s.total"))


@query("st6_restarted", """
SELECT v.user_id AS key, v.event_id AS left_id, p.event_id AS right_id
FROM events v JOIN events p ON v.user_id = p.user_id AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL '1 hour'
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def st6_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join of two streams whose rows wait in state for late partners, over a restart."""

    def make(s: DataFrame) -> DataFrame:
        return E.interval_join(s.where("event_type = 'view'"), s.where("event_type = 'purchase'"), "user_id", "1 HOUR", DELAY)

    return restarted(spark, sf_dir, "st6r", make).drop("batch")


@query("st5_timed_sessions", f"""
WITH marked AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS fresh FROM events),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked),
made AS (
  SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", count(*) AS n, round(sum(value), 2) AS total,
         count(DISTINCT event_type) AS kinds, count(*) FILTER (event_type = 'view') AS seen
  FROM numbered GROUP BY user_id, s HAVING date_trunc('milliseconds', max(ts) + INTERVAL '30 minutes') < date_trunc('milliseconds', {CLOSED_LATE})
)
SELECT user_id, start, "end", n, total, kinds, sum(seen) OVER (PARTITION BY user_id ORDER BY start)::BIGINT AS views FROM made
""")
def st5_timed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom state in RocksDB (a list, a map, a value), closed by event-time timers, over late files and a restart."""
    with stateful.rocksdb(spark):
        return plain(restarted(spark, sf_dir, "st5t", lambda s: stateful.timed_sessions(s, 1800, DELAY)).drop("batch"))


@query("st4_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def st4_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup by map state with a time to live of a day, which no run here reaches, over a restart."""
    with stateful.rocksdb(spark):
        return restarted(spark, sf_dir, "st4f", lambda s: stateful.first_seen(s, 86_400_000), endless=True).select("user_id", "event_type")
