"""Exact percentiles of groups of any size by distributed selection.

For each rank that is asked of a group, an interval of values that holds it is narrowed: cut points from a
sketch cut the interval, exact counts of what lies between and on them say which part holds the rank, and
that part is the next interval, until it holds at most ``limit`` values or a single one. Then one pass
counts the values of the intervals. No task ever holds a group; small groups go to the last pass at once.

Nulls are left out; NaN is the greatest value; a group without values has no row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfold.sources.tables import scratch_path

#: Values of an interval that are counted one by one; cut points of a round.
LIMIT, CUTS = 100_000, 32


def percentiles(spark: SparkSession, df: DataFrame, by: str, value: str, shares: dict[str, float], limit: int = LIMIT) -> DataFrame:
    """(by, one column for each share): linear interpolation between the two nearest ranks."""
    path, rounds = scratch_path(spark, "selection"), 0
    values = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    groups = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))

    def stored(state: DataFrame) -> DataFrame:
        nonlocal rounds
        rounds += 1
        state.write.parquet(f"{path}/round={rounds}")
        return spark.read.schema(state.schema).parquet(f"{path}/round={rounds}")

    spots = [F.lit(p) * (F.col("n") - 1) for p in shares.values()]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(s), F.ceil(s)) for s in spots])))
    state = stored(groups.select("g", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")))
    large = (F.col("inside") > limit) & (F.col("lo") < F.col("hi"))
    while state.where(large).limit(1).count():
        # A group is in here only with more than limit values: its rows are few beside the table's.
        wide = state.where(large).withColumnRenamed("g", "wg")
        within = values.join(F.broadcast(wide), F.col("g").eqNullSafe(F.col("wg"))).where("v >= lo AND v <= hi").drop("wg", "lo", "hi")
        cuts = within.groupBy("g", "rank").agg(F.array_distinct(F.percentile_approx("v", [i / (CUTS + 1) for i in range(1, CUTS + 1)], 100 * CUTS)).alias("cuts"))
        keyed = F.broadcast(cuts.withColumnsRenamed({"g": "cg", "rank": "crank"}))
        cut = within.join(keyed, F.col("g").eqNullSafe(F.col("cg")) & (F.col("rank") == F.col("crank")))
        # Values between two cut points and those on one are parts of their own.
        part = 2 * F.size(F.filter("cuts", lambda c: c < F.col("v"))) + F.array_contains("cuts", F.col("v")).cast("int")
        counted = cut.groupBy("g", "rank", "below", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = F.sum("n").over(Window.partitionBy("g", "rank").orderBy("part")) - F.col("n") + F.col("below")
        found = counted.withColumn("start", before).where("rank >= start AND rank < start + n").select("g", "rank", "lo", "hi", F.col("start").alias("below"), F.col("n").alias("inside"))
        state = stored(state.where(~large).unionByName(found))

    # At most limit different values a rank, or one.
    many = state.where("lo < hi").withColumnRenamed("g", "sg")
    near = values.join(many, F.col("g").eqNullSafe(F.col("sg"))).where("v >= lo AND v <= hi").groupBy("g", "rank", "below", "v").agg(F.count(F.lit(1)).alias("n"))
    start = F.sum("n").over(Window.partitionBy("g", "rank").orderBy("v")) - F.col("n") + F.col("below")
    picked = near.withColumn("start", start).where("rank >= start AND rank < start + n").select("g", "rank", "v").unionByName(state.where("NOT lo < hi").select("g", "rank", F.col("lo").alias("v")))
    by_rank = picked.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two ranks a share
    sized = groups.select("g", "n").join(by_rank.withColumnRenamed("g", "rg"), F.col("g").eqNullSafe(F.col("rg")))

    def interpolated(p: float):
        spot = F.lit(p) * (F.col("n") - 1)
        low, high = F.col("at")[F.floor(spot)], F.col("at")[F.ceil(spot)]
        return F.when(F.floor(spot) == F.ceil(spot), low).otherwise(low + (high - low) * (spot - F.floor(spot)))

    return sized.select(F.col("g").alias(by), *[interpolated(p).alias(name) for name, p in shares.items()])
