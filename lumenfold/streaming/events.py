"""Streaming forms of event queries, run over stored events as an available-now stream.

Event time must be a timestamp with zone: watermarks refuse timestamp_ntz in a stream. In append mode
the windows that the watermark has not passed are not emitted; the queries here use complete mode where
an exact batch twin is wanted."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.sources.tables import table
from lumenfold.streaming.stateful import USER, by_bucket, pack, unpack, users


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files, with a time that can carry a watermark."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return _counted(events.withWatermark("ts", late), F.window("ts", width))


def sliding(events: DataFrame, width: str = "1 hour", step: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return _counted(events.withWatermark("ts", late), F.window("ts", width, step))


def _counted(events: DataFrame, window) -> DataFrame:
    return events.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    counted = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """First event of each key within the watermark; state is dropped as the watermark passes."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def interval_join(left: DataFrame, right: DataFrame, key: str, within: str, late: str = "10 minutes") -> DataFrame:
    """Pairs of a key where the right's time is at most ``within`` after the left's; both sides' state is bounded."""
    a = left.withWatermark("ts", late).select(F.col(key).alias("key"), F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    b = right.withWatermark("ts", late).select(F.col(key).alias("right_key"), F.col("event_id").alias("right_id"), F.col("ts").alias("right_ts"))
    return a.join(b, F.expr(f"key = right_key AND right_ts > left_ts AND right_ts <= left_ts + INTERVAL {within}")).select("key", "left_id", "right_id")


def running_totals(events: DataFrame) -> DataFrame:
    """Custom state: each user's number of events and sum so far, one row a user and batch.

    A key of the state is a bucket of users, whose totals are held packed."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        new = pd.concat([b.groupby(USER)["value"].agg(["size", "sum"]) for b in batches]).groupby(level=USER).sum()
        old = unpack([state.get[0]]).set_index(USER) if state.exists else new.iloc[:0]
        held = new.add(old, fill_value=0).astype({"size": "int64"})
        state.update((pack(held.reset_index()),))
        out = held.loc[new.index].reset_index()
        yield pd.DataFrame({"user_id": users(out), "n": out["size"], "total": out["sum"]})

    return by_bucket(events, "value").applyInPandasWithState(update, "user_id long, n long, total double", "held binary", "update", "NoTimeout")


def run_to_memory(spark: SparkSession, stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Run a stream over what there is, and return what it wrote: for tests and small results only."""
    running = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.table(name)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an append-mode stream over what there is into Parquet files, exactly once."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def run_through_files(spark: SparkSession, stream: DataFrame, path: str) -> DataFrame:
    """run_to_parquet() under a path, read back."""
    run_to_parquet(stream, f"{path}/rows", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def run_updates(spark: SparkSession, stream: DataFrame, path: str) -> DataFrame:
    """Run an update-mode stream over what there is; every batch is a folder of its own, so that a batch
    that is repeated replaces itself. Returns the rows of all batches with their number."""

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{path}/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")
