"""Selection, frames, aggregates and sketches on small frames, against brute force and one-task forms."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenfold.functions.aggregators import geometric_mean, grouped_geometric_mean, weighted_variance
from lumenfold.functions.sketches import CountMin
from lumenfold.operators import frames
from lumenfold.operators.selection import percentiles


@pytest.mark.parametrize("limit", [5, 100_000])
def test_percentiles(spark, limit):
    rng = random.Random(limit)
    rows = [("hot", rng.choice([1.0, 1.0, 1.0, rng.random(), rng.gauss(0, 1e6)])) for _ in range(3000)] + [("same", 7.0)] * 500 + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), (None, 5.0), (None, 6.0)]
    rows += [("wide", 10.0 ** rng.randrange(-300, 300)) for _ in range(400)]
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["k"]: tuple(r)[1:] for r in percentiles(spark, spark.createDataFrame(rows, "k string, v double"), "k", "v", shares, limit).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert got[k] == pytest.approx([float(np.quantile(values, p)) for p in shares.values()], rel=1e-9), k


def test_groups_frame_is_many_tasks(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", None]), rng.choice([None, *range(30)]), rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k string, x int, v double")
    for partition in (["k"], []):
        got = frames.groups_frame(spark, df, partition, "x", {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}, 2, 1)
        ranked = df.withColumn("g", F.dense_rank().over(Window.partitionBy(*partition).orderBy("x")))
        w = Window.partitionBy(*partition).orderBy("g").rangeBetween(-2, 1)
        want = ranked.select(*df.columns, F.count("v").over(w).alias("n"), F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("lo"), F.max("v").over(w).alias("hi"))
        flat = lambda d: sorted([r["i"], r["n"], round(r["s"], 9), r["lo"], r["hi"]] for r in d.collect())
        assert flat(got) == flat(want) and got.columns == want.columns


def test_range_frame(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, rng.randrange(1000)]), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, x long, v double")
    want = []
    for i, x, _ in rows:
        near = [v for _, y, v in rows if x is not None and y is not None and x - 40 <= y <= x + 7]
        want.append((i, len(near) or None, round(sum(near), 9) if near else None))
    for width in (10, 100, 5000):
        got = frames.range_frame(df, [], "x", {"n": ("count", "v"), "s": ("sum", "v")}, 40, 7, width)
        assert sorted((r["i"], r["n"], r["s"] and round(r["s"], 9)) for r in got.collect()) == want
    cut = frames.range_frame(df, [], "x", {"n": ("count", "v")}, 40, 7, 50)
    assert "_bucket" in cut._jdf.queryExecution().executedPlan().toString()


def test_two_phases_equal_one(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, -1.0, rng.random() + 1]), rng.random()) for _ in range(3000)] + [("neg", -1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, w double").repartition(6)
    got = {r["k"]: r["m"] for r in geometric_mean(df, "k", "m", x=F.col("x")).collect()}
    one = {r["k"]: r["m"] for r in df.where("x > 0").groupBy("k").agg(grouped_geometric_mean("x").alias("m")).collect()}
    assert got == pytest.approx(one)
    var = {r["k"]: r["v"] for r in weighted_variance(df, "k", "v", x=F.col("x"), w=F.col("w")).collect()}
    for k in ("a", "b", None):
        x, w = zip(*[(x, w) for j, x, w in rows if j == k and x is not None])
        assert var[k] == pytest.approx(np.average((np.array(x) - np.average(x, weights=w)) ** 2, weights=w))
    assert geometric_mean(df.limit(0), "k", "m", x=F.col("x")).count() == 0


def test_count_min_bytes(spark):
    rng = random.Random(2)
    items = [rng.choice([1, 2, rng.randrange(-(1 << 62), 1 << 62)]) for _ in range(3000)]
    df = spark.createDataFrame([(i,) for i in items], "x long")
    sketch = CountMin(bytes(df.agg(F.count_min_sketch("x", F.lit(0.001), F.lit(0.99), F.lit(5))).first()[0]))
    asked = sorted(set(items)) + [77, -5]
    about = sketch.counts(np.array(asked))
    assert sketch.total == len(items) and all(items.count(x) <= n <= items.count(x) + 6 for x, n in zip(asked, about.tolist()))
    with pytest.raises(ValueError):
        CountMin(b"\0\0\0\2" + bytes(60))
