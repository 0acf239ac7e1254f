"""Shared storage for intermediate tables and files.

Everything that more than one task or job reads lives under the folder named by
``spark.checkpoint.dir``, which all executors see. Where a local session has none (tests, a laptop), a
temporary folder is set, as everything then runs on one machine; on a cluster that is an error.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lumenfold-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = path or new_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Write df to the shared folder in buckets of the keys: joins and aggregations by them read it
    without a shuffle, as often as needed. The catalogue keeps no entry of it: the frame knows its files."""
    label, buckets = f"{name}_{uuid.uuid4().hex}", buckets or partitions(spark)
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{shared_dir(spark)}/{label}").option("compression", "zstd").saveAsTable(label)
    stored = spark.table(label)
    spark.sql(f"DROP TABLE {label}")  # an external table: its files stay
    return stored


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of df has it, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path that new_path() made."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else uri
    return None


def _remote(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def publish(uri: str):
    """A binary file for writing that appears under uri only when it is whole; a repeated task replaces it."""
    temp = f"{uri}.{uuid.uuid4().hex}.tmp"
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(_local(temp), "wb") as f:
            yield f
        os.replace(_local(temp), path)
    else:
        store, path = _remote(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        with store.open_output_stream(_remote(temp)[1]) as f:
            yield f
        store.move(_remote(temp)[1], path)


def open_read(uri: str):
    """A seekable binary file."""
    if path := _local(uri):
        return open(path, "rb")
    store, path = _remote(uri)
    return store.open_input_file(path)


def map_file(uri: str, dtype):
    """The file as a numpy array: memory-mapped where the store is a mounted folder, else read whole."""
    import numpy as np

    if path := _local(uri):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with open_read(uri) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def trim() -> None:
    """Give memory that a task has freed back to the system: workers are reused and would hold on to it."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)
