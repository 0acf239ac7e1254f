"""Stored rows replayed as a stream of many files, in the order of arrival, over several batches and a restart.

Files are written by one job, cut by arrival time, and stamped in that order (a file source takes the oldest
first). Every batch is stored in a folder of its own that a repeated batch replaces, so a run that is
stopped between the write and the commit of a batch gives the same rows after its restart: offsets, state
and watermark come from the checkpoint, and the batch is run again from the state before it."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STOP = "stopped before the commit"


def write_in_order(spark: SparkSession, rows: DataFrame, arrival: Column, path: str, files: int) -> None:
    """Write rows as so many files by rising arrival, a second apart in modification time.

    Borders are sampled by Spark's range partitioning, so files may differ in size, and there may be fewer."""
    rows.repartitionByRange(files, arrival).write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    latest = jvm.System.currentTimeMillis()
    for i, part in enumerate(parts):
        fs.setTimes(part, latest - 1000 * (len(parts) - i), -1)


def file_stream(spark: SparkSession, path: str, schema, files_a_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def run_batches(stream: DataFrame, path: str, mode: str, stop_in: int | None = None, endless: bool = False) -> list[int]:
    """Run what there is; every batch goes to a folder. With stop_in, that batch is written and the run then
    ends before it is committed. Returns the batches that this run has finished.

    endless: for state that lives by processing time. Spark then runs a batch without input after another,
    and never sees that an available-now stream is done; so the stream is stopped after the first of these."""
    done: list[int] = []

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
        if batch == stop_in:
            raise RuntimeError(STOP)
        done.append(batch)

    try:
        writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{path}/checkpoint").outputMode(mode)
        running = (writer.trigger(processingTime="0 seconds") if endless else writer.trigger(availableNow=True)).start()
        while endless and running.isActive and not any(p.numInputRows == 0 for p in running.recentProgress):
            time.sleep(0.05)
        if endless and running.isActive:
            running.stop()
        running.awaitTermination()
    except StreamingQueryException as e:
        if stop_in is None or STOP not in str(e):
            raise
    return done


def run_with_restart(spark: SparkSession, stream: DataFrame, path: str, mode: str, stop_in: int, least: int = 6, endless: bool = False) -> DataFrame:
    """Run until a batch is stopped, run again from the checkpoint to the end; the rows of all batches.

    It is an error if the run wasn't stopped or had fewer batches than ``least``."""
    before = run_batches(stream, path, mode, stop_in, endless)
    after = run_batches(stream, path, mode, None, endless)
    if not after or after[0] != stop_in or before != list(range(stop_in)):
        raise RuntimeError(f"batches {before} before the stop and {after} after it")
    if len(before) + len(after) < least:
        raise RuntimeError(f"{len(before) + len(after)} batches; {least} were to be run")
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")


def delayed(events: DataFrame, hours: int) -> Column:
    """A time of arrival: a tenth of the events, by a hash of the id, come so many hours late."""
    return F.when(F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0, F.col("ts") + F.expr(f"INTERVAL {hours} HOURS")).otherwise(F.col("ts"))
