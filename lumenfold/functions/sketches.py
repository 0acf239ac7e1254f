"""Point queries on the count-min sketches that SQL makes.

The bytes are Spark's own format: version, total count, depth, width, one hash factor a row, then the rows
of counters. A long's counter in a row is its product with the factor, folded to 31 bits, by the width."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CountMin:
    def __init__(self, data: bytes):
        version, = np.frombuffer(data, ">i4", 1)
        if version != 1:
            raise ValueError(f"count-min sketch of version {version}")
        self.total = int(np.frombuffer(data, ">i8", 1, 4)[0])
        depth, self.width = (int(x) for x in np.frombuffer(data, ">i4", 2, 12))
        self.factors = np.frombuffer(data, ">i8", depth, 20).astype(np.int64)
        self.rows = np.frombuffer(data, ">i8", depth * self.width, 20 + 8 * depth).astype(np.int64).reshape(depth, self.width)

    def counts(self, items: np.ndarray) -> np.ndarray:
        """At least the items' counts, and at most eps * total more with the sketch's confidence."""
        out = None
        for factor, row in zip(self.factors, self.rows):
            with np.errstate(over="ignore"):
                h = factor * items.astype(np.int64)
                h = h + (h >> 32)
            found = row[(h & 0x7FFFFFFF) % self.width]
            out = found if out is None else np.minimum(out, found)
        return out


#: Bytes of sketches that tasks hold, at most.
MOST_BYTES = 64 << 20


def count_min_estimates(spark: SparkSession, items: DataFrame, by: str, item: str, sketches: DataFrame) -> DataFrame:
    """items with a column about: the item's count by the sketch (by, sketch) of its key.

    The sketches go to all tasks, so their size is checked first; it is bounded by that of one sketch and the
    number of keys. An item whose key has no sketch has a null."""
    size = sketches.agg(F.coalesce(F.sum(F.octet_length("sketch")), F.lit(0))).first()[0]
    if size > MOST_BYTES:
        raise ValueError(f"{size} bytes of sketches; at most {MOST_BYTES} are sent to tasks")
    held = spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in sketches.select(by, "sketch").collect()})
    out = items.select(*items.columns, F.lit(None).cast("long").alias("about"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict = {}
        for b in batches:
            about = np.full(b.num_rows, -1, np.int64)
            for key, rows in pd.Series(range(b.num_rows)).groupby(b.column(by).to_pandas()):
                if key in held.value:
                    sketch = read.setdefault(key, CountMin(held.value[key])) if key not in read else read[key]
                    about[rows] = sketch.counts(b.column(item).take(pa.array(rows)).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(about, mask=about < 0)], b.schema.names)

    return out.where(F.col(item).isNotNull()).mapInArrow(ask, out.schema)
