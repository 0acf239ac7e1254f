"""GROUPS and RANGE frames over window partitions of any size.

Peers (rows of one partition and order value) are aggregated first, with partial sums. For a GROUPS frame
they are numbered by a range partitioning and prefix sums, and each sends its aggregate to the frames that
it is in, a fixed number. For a RANGE frame the axis is cut into buckets wider than the frame; peers near a
border are copied to the next bucket (a halo), and each bucket is worked on by itself: numbers as arrays, in
n log n steps whatever the width of the frames, other types by a window, which takes rows times frame. So a table that is
one window partition is as many tasks as it has ranges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfold.sources.tables import scratch_path

#: How partial aggregates merge.
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
#: Types whose RANGE frames are found in arrays; rows of whole buckets that are worked on at once.
NUMBERS, ROWS = ("tinyint", "smallint", "int", "bigint", "float", "double"), 50_000
MAKE = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _peers(df: DataFrame, partition: list[str], order: str, aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(partition)]
    return df.groupBy(*keys, F.col(order).alias("_x")).agg(*[MAKE[kind](column).alias(f"_{name}") for name, (kind, column) in aggregates.items()])


def _back(df: DataFrame, frames: DataFrame, partition: list[str], order: str, aggregates: dict) -> DataFrame:
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(partition)] + [F.col(order).eqNullSafe(F.col("_x"))]
    joined = df.join(frames, reduce(lambda a, b: a & b, same), "left")
    return joined.select(*df.columns, *[F.col(f"_{name}").alias(name) for name in aggregates])


def groups_frame(spark: SparkSession, df: DataFrame, partition: list[str], order: str, aggregates: dict[str, tuple[str, str]], before: int, after: int) -> DataFrame:
    """df with aggregates {name: (kind, column)} over GROUPS BETWEEN before PRECEDING AND after FOLLOWING.

    Nulls in the order column are one group, which comes first."""
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [f"_k{i}" for i in range(len(partition))]
    ordered = _peers(df, partition, order, aggregates).repartitionByRange(parts, *keys, "_x").sortWithinPartitions(*keys, "_x")
    at = F.monotonically_increasing_id()  # counts from 0 in each part, whose number is in the upper bits
    path = scratch_path(spark, "peers")
    ordered.withColumns({"_part": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes, base, bases = sorted(tuple(r) for r in stored.groupBy("_part").agg(F.max("_at") + 1).collect()), 0, []
    for part, size in sizes:
        bases.append((part, base))
        base += size
    numbered = stored.join(F.broadcast(spark.createDataFrame(bases, "_part long, _base long")), "_part").withColumn("_g", F.col("_base") + F.col("_at"))  # a row for each part
    # Peers of one partition have consecutive numbers; a frame is reached from after numbers below to before above.
    sent = numbered.select(*keys, F.explode(F.sequence(F.col("_g") - after, F.col("_g") + before)).alias("_g"), *[f"_{n}" for n in aggregates])
    frames = sent.groupBy(*[F.col(k).alias(f"_f{k}") for k in keys], F.col("_g").alias("_f_at")).agg(*[MERGE[kind](f"_{n}").alias(f"_f_{n}") for n, (kind, _) in aggregates.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_f{k}")) for k in keys] + [F.col("_g") == F.col("_f_at")]
    own = numbered.select(*keys, "_x", "_g").join(frames, reduce(lambda a, b: a & b, same)).select(*keys, "_x", *[F.col(f"_f_{n}").alias(f"_{n}") for n in aggregates])
    return _back(df, own, partition, order, aggregates)


def range_frame(df: DataFrame, partition: list[str], order: str, aggregates: dict[str, tuple[str, str]], before: float, after: float, width: float) -> DataFrame:
    """df with aggregates over RANGE BETWEEN before PRECEDING AND after FOLLOWING of a numeric column.

    width: of a bucket. Any gives the same rows; a task holds the different values of about one bucket and its halo.
    Rows whose order value is null have null aggregates."""
    if width <= 0 or before < 0 or after < 0:
        raise ValueError("a bucket has a positive width, a frame no negative reach")
    peers = _peers(df, partition, order, aggregates).where("_x IS NOT NULL")
    bucket = lambda x: F.floor(x / width)
    spread = peers.withColumn("_own", bucket(F.col("_x"))).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_x") - after), bucket(F.col("_x") + before))))
    keys = [f"_k{i}" for i in range(len(partition))]
    w = Window.partitionBy(*keys, "_bucket").orderBy("_x")
    types = dict(spread.dtypes)
    if all(types[c] in NUMBERS for c in ("_x", *[f"_{n}" for n in aggregates])):
        # The window sorts each bucket's rows and marks its first; they come out of it in that order.
        marked = spread.withColumn("_first", F.row_number().over(w) == 1)
        kinds = {f"_{n}": kind for n, (kind, _) in aggregates.items()}
        framed = marked.mapInArrow(lambda batches: _framed(batches, kinds, before, after), marked.schema)
    else:
        framed = spread.select(*keys, "_x", "_own", "_bucket", *[MERGE[kind](f"_{n}").over(w.rangeBetween(-before, after)).alias(f"_{n}") for n, (kind, _) in aggregates.items()])
    return _back(df, framed.where("_own = _bucket").drop("_own", "_bucket", "_first"), partition, order, aggregates)


def _framed(batches: Iterator[pa.RecordBatch], kinds: dict[str, str], before: float, after: float) -> Iterator[pa.RecordBatch]:
    """Rows with their frames' aggregates, of batches that are sorted by bucket and order, some whole buckets at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        firsts = np.flatnonzero(b.column("_first").to_numpy(zero_copy_only=False))
        if len(firsts) and sum(x.num_rows for x in held) + firsts[-1] >= ROWS:
            yield from _aggregated(pa.Table.from_batches([*held, b.slice(0, firsts[-1])]), kinds, before, after)
            held, b = [], b.slice(firsts[-1])
        held.append(b)
    if held:
        yield from _aggregated(pa.Table.from_batches(held), kinds, before, after)


def _aggregated(rows: pa.Table, kinds: dict[str, str], before: float, after: float) -> Iterator[pa.RecordBatch]:
    x = rows["_x"].to_numpy()
    starts = np.flatnonzero(rows["_first"].to_numpy())
    low, high = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(x)]):
        low[a:b] = a + np.searchsorted(x[a:b], x[a:b] - before, "left")
        high[a:b] = a + np.searchsorted(x[a:b], x[a:b] + after, "right")
    for name, kind in kinds.items():
        at, column = rows.schema.get_field_index(name), rows[name].combine_chunks()
        known, whole = np.asarray(column.is_valid()), pa.types.is_integer(column.type)
        merge, empty = {"sum": (np.add, 0), "count": (np.add, 0), "min": (np.minimum if whole else np.fmin, np.iinfo(np.int64).max if whole else np.nan), "max": (np.maximum, np.iinfo(np.int64).min if whole else -np.inf)}[kind]
        values = np.where(known, column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64 if whole else np.float64), empty)
        out = _over(values, low, high, merge, empty)
        if whole and kind == "sum" and (np.abs(_over(values.astype(np.float64), low, high, np.add, 0)) >= 2.0**63).any():
            raise OverflowError(f"a sum of {name[1:]} is above the range of long")
        none = _over(known.astype(np.int64), low, high, np.add, 0) == 0
        rows = rows.set_column(at, rows.schema.field(at), pa.array(out, mask=none).cast(column.type))
    yield from rows.combine_chunks().to_batches(max_chunksize=10_000)


def _over(values: np.ndarray, low: np.ndarray, high: np.ndarray, merge: np.ufunc, empty: float) -> np.ndarray:
    """merge() of values[low:high] for each pair, from runs of 1, 2, 4 ... values: n log n steps, and no differences
    of running sums, which would lose digits."""
    out, at, length = np.full(len(low), empty, values.dtype), low.copy(), high - low
    runs, size = values, 1
    while (length >= size).any():
        here = np.flatnonzero(length & size)
        out[here] = merge(out[here], runs[at[here]])
        at[here] += size
        runs = merge(runs[:-size], runs[size:])
        size *= 2
    return out

