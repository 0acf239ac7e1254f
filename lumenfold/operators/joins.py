"""Joins that Spark has no operator for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, ties: list[str], columns: list[str], bucket_seconds: int | None = None) -> DataFrame:
    """Each row of left with the latest row of right of the same key that is not after it.

    One shuffle by key: the two sides are united, and the last right row seen is carried forward in time
    order, so nothing is ever paired off. Ties in right's time go to the greatest by the tie columns. With
    bucket_seconds, keys are also cut into time buckets (a hot key is then many tasks), and a row whose
    bucket has no earlier right row gets the last one of the buckets before, from one row a bucket.
    ``columns`` are the right's columns to add; they are null where there is no match."""
    seen = F.struct(F.col(right_time).alias("_time"), *[F.col(c).alias(f"_tie_{c}") for c in ties], *columns)
    events = right.select(*by, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), seen.alias("_seen"), *[F.lit(None).cast(left.schema[c].dataType).alias(f"_l_{c}") for c in left.columns])
    probes = left.select(*by, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(events.schema["_seen"].dataType).alias("_seen"), *[F.col(c).alias(f"_l_{c}") for c in left.columns])
    both = events.unionByName(probes)
    keys = list(by)
    if bucket_seconds:
        both = both.withColumn("_bucket", F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / (bucket_seconds * 1_000_000)))
        keys.append("_bucket")
    order = [F.col("_at"), F.col("_side"), *[F.col(f"_seen._tie_{c}") for c in ties]]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    matched = both.withColumn("_last", F.last("_seen", ignorenulls=True).over(window)).where("_side = 1")
    if bucket_seconds:
        ends = both.where("_side = 0").groupBy(*keys).agg(F.max("_seen").alias("_end"))
        probed = both.where("_side = 1").select(*keys).distinct()
        marks = probed.join(ends, keys, "full")
        earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        marks = marks.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).select(*keys, "_before")
        matched = matched.join(marks, keys, "left").withColumn("_last", F.coalesce("_last", "_before"))
    return matched.select(*[F.col(f"_l_{c}").alias(c) for c in left.columns], *[F.col(f"_last.{c}").alias(c) for c in columns])


def band_join(left: DataFrame, right: DataFrame, left_value: Column, low: Column, high: Column, width: float) -> DataFrame:
    """Pairs with low <= left_value <= high, for right intervals that are short beside the bands.

    The axis is cut into bands of the given width; an interval is listed in each band that it meets, a
    value in its one, so the join is an equi-join on bands and no pair is found twice."""
    probe = left.withColumn("_value", left_value.cast("double")).withColumn("_band", F.floor(F.col("_value") / width))
    listed = right.withColumns({"_low": low.cast("double"), "_high": high.cast("double")}).where("_low <= _high")
    listed = listed.withColumn("_band", F.explode(F.sequence(F.floor(F.col("_low") / width), F.floor(F.col("_high") / width))))
    return probe.join(listed, "_band").where("_value >= _low AND _value <= _high").drop("_band", "_value", "_low", "_high")
