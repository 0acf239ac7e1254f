"""Steps whose work or state must not grow faster than the input."""

import random
import time
import types
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenfold.functions import aggregators
from lumenfold.operators import fixpoint, frames, set_similarity
from lumenfold.plans import load_all
from lumenfold.plans.registry import QUERIES
from lumenfold.streaming import events, replay, stateful

DATA = "/root/testdata/sf0.01"
load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_items_of_more_users_than_a_sketch_tracks(spark, tmp_path):
    users = spark.range(40_000).select(F.col("id").alias("user_id"), F.when(F.col("id") % 4000 == 0, 20 + F.col("id") / 4000).otherwise(1 + F.col("id") % 15).cast("int").alias("n"))
    users.select("user_id", F.explode(F.sequence(F.lit(1), "n"))).repartition(8).select("user_id").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["ag11_top_items"](spark, str(tmp_path))
    assert sorted((r["place"], r["n"]) for r in got.collect()) == [(i + 1, 29 - i) for i in range(10)]


def test_grouped_mean_takes_no_call_for_each_group(spark):
    got = plan(QUERIES["ud4_grouped_agg"](spark, DATA))
    assert "MapInArrow" in got and "AggregateInPandas" not in got and "ArrowAggregatePython" not in got


def test_two_phases_keep_groups_without_values_and_large_keys(spark):
    big = (1 << 60) + 1
    rows = [(big, 2.0), (big, 8.0), (big + 1, 3.0), (None, 5.0), (7, None), (8, -1.0)]
    df = spark.createDataFrame(rows, "k long, x double").coalesce(1)
    got = {r["k"]: r["m"] for r in aggregators.geometric_mean_or_null(df, "k", "m", x=F.col("x")).collect()}
    assert got == {big: pytest.approx(4.0), big + 1: pytest.approx(3.0), None: pytest.approx(5.0), 7: None, 8: None}


def test_two_phases_send_states_on(spark):
    df = spark.range(3 * aggregators.HELD).select((F.col("id") % (aggregators.HELD + 9)).alias("k"), F.lit(2.0).alias("x")).coalesce(1)
    got = aggregators.geometric_mean(df, "k", "m", x=F.col("x"))
    assert got.count() == aggregators.HELD + 9 and got.agg(F.min("m"), F.max("m")).first() == (pytest.approx(2.0), pytest.approx(2.0))


def test_wide_range_frames_take_no_window_frame(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", None]), rng.choice([None, rng.randrange(500)]), rng.choice([None, rng.randrange(-9, 9)]), rng.choice([None, float("nan"), rng.random()])) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, k string, x long, v long, d double")
    asked = {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "dlo": ("min", "d"), "dhi": ("max", "d")}
    got = frames.range_frame(df, ["k"], "x", asked, 60, 20, 100)
    df.createOrReplaceTempView("wide_frames")
    w = "OVER (PARTITION BY k ORDER BY x RANGE BETWEEN 60 PRECEDING AND 20 FOLLOWING)"
    want = spark.sql(f"SELECT *, {', '.join(f'{f}({c}) {w} AS {n}' for n, (f, c) in asked.items())} FROM wide_frames WHERE x IS NOT NULL")
    text = lambda d: sorted(map(str, d.collect()))
    assert text(got.where("x IS NOT NULL")) == text(want) and got.where("x IS NULL AND n IS NULL").count() == df.where("x IS NULL").count()
    assert "RangeFrame, -60" not in plan(got) and "MapInArrow" in plan(got)


def test_no_sketch_for_each_key(spark):
    lines = plan(QUERIES["ag6_approx_distinct"](spark, DATA)).splitlines()
    assert any("approx_count_distinct" in x for x in lines)
    assert not any("keys=[o_custkey" in x and "approx_count_distinct" in x for x in lines)


def test_timed_sessions_without_user_or_kind(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    begin, big = datetime(2024, 1, 1), (1 << 60) + 1
    for rows in ([(0, None, "view"), (1, big, None), (2, big + 1, "view"), (3, None, "a")], [(500, None, "view"), (501, big, "view")], [(2000, 1, "a")], [(3000, 1, "a")]):
        spark.createDataFrame([(i, begin + timedelta(minutes=m), u, k, 1.0) for i, (m, u, k) in enumerate(rows)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
        with stateful.rocksdb(spark):
            replay.run_batches(stateful.timed_sessions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 1800, "60 minutes"), str(tmp_path), "append")
    got = {(r["user_id"], (r["start"] - begin).seconds // 60, r["n"], r["total"], r["kinds"], r["views"]) for r in spark.read.parquet(f"{tmp_path}/rows").where("start < '2024-01-02'").collect()}
    assert got == {(None, 0, 2, 2.0, 2, 1), (big, 1, 1, 1.0, 0, 0), (big + 1, 2, 1, 1.0, 1, 1), (None, 500, 1, 1.0, 1, 2), (big, 501, 1, 1.0, 1, 1)}


def test_first_seen_without_user_or_kind(spark, tmp_path):
    schema, big = "event_id long, user_id long, event_type string", (1 << 60) + 1
    pairs = [(None, "a"), (big, None), (big + 1, "a"), (big, "")]
    for _ in range(2):
        spark.createDataFrame([(i, u, k) for i, (u, k) in enumerate(pairs * 2)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        with stateful.rocksdb(spark):
            replay.run_batches(stateful.first_seen(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 86_400_000), str(tmp_path), "append", endless=True)
    assert sorted(map(str, pairs)) == sorted(str((r[0], r[1])) for r in spark.read.parquet(f"{tmp_path}/rows").select("user_id", "event_type").collect())


def test_totals_are_kept_by_bucket(spark, tmp_path):
    users = [*range(3 * stateful.BUCKETS), None, (1 << 60) + 1]
    spark.createDataFrame([(u, float(i)) for u in users for i in range(2)], "user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = events.running_totals(spark.readStream.schema("user_id long, value double").parquet(f"{tmp_path}/in"))
    replay.run_batches(stream, str(tmp_path), "update")
    got = {r["user_id"]: (r["n"], r["total"]) for r in spark.read.parquet(f"{tmp_path}/rows").collect()}
    assert got == {u: (2, 1.0) for u in users}
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= stateful.BUCKETS


def test_edges_are_shuffled_once(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 2)], "src long, dst long")
    monkeypatch.setattr(fixpoint, "uuid", types.SimpleNamespace(uuid4=lambda: types.SimpleNamespace(hex="x")))
    kept = []
    monkeypatch.setattr(type(edges), "write", property(lambda self, f=type(edges).write: (kept.append(plan(self)), f.fget(self))[1]))
    assert {tuple(r) for r in fixpoint.reach(spark, edges, spark.range(1, 2).select(F.col("id").alias("node"))).collect()} == {(1, 0), (2, 1)}
    assert kept[0].count("Exchange hashpartitioning") == 1


def test_whole_sets_are_not_stored(spark):
    docs = spark.createDataFrame([(i, [f"t{i % 40}-{k}" for k in range(100 + i // 40)]) for i in range(80)], "id long, words array<string>")
    joined = set_similarity.Join(spark, set_similarity.token_sets(docs, F.col("words"), "id"), 0.8)
    assert "tokens" not in joined.classes.columns and joined.links.count() == 40
