"""Columnar hand-over between tasks: numpy columns cut by bucket and sent as one compressed row a bucket.

A shuffle of millions of short rows costs the JVM more than the work on them; packed, a task sends one
row for each bucket and batch. The receiving task sees bytes that it unpacks into the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

SCHEMA = "bucket int, blob binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64): spreads keys over buckets."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack(*columns: np.ndarray | bytes, level: int = 1) -> bytes:
    """Arrays and byte strings as one compressed string."""
    parts = [c if isinstance(c, bytes) else c.dtype.str.encode() + b"\0" + c.tobytes() for c in columns]
    kinds = bytes(isinstance(c, bytes) for c in columns)
    head = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + kinds + b"".join(parts))


def unpack(blob: bytes) -> list:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    lengths = np.frombuffer(data, "<i8", n, 8)
    kinds = data[8 + 8 * n : 8 + 9 * n]
    at, out = 8 + 9 * n, []
    for length, plain in zip(lengths.tolist(), kinds):
        part = data[at : at + length]
        at += length
        if plain:
            out.append(part)
        else:
            kind, _, body = part.partition(b"\0")
            out.append(np.frombuffer(body, np.dtype(kind.decode())))
    return out


def cut(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    start = 0
    for end in ends:
        rows = order[start:end]
        yield int(bucket[rows[0]]), [c[rows] for c in columns]
        start = end


def batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())], ["bucket", "blob"])


def deal(df: DataFrame, buckets: int) -> DataFrame:
    """Send bucket i to task i."""
    return df.repartitionById(buckets, "bucket")
