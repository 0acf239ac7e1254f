"""User-defined functions of each kind; all but the plain one move data as Arrow batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@F.pandas_udf(T.LongType())
def log_bucket(values: pd.Series) -> pd.Series:
    """The power of two below 1 + |x|."""
    return np.floor(np.log2(1 + values.abs())).astype("Int64")


@F.udtf(returnType=T.StructType().add("length", T.LongType()).add("n", T.LongType()), useArrow=True)
class TokenLengths:
    """How many tokens of each length a text has."""

    def eval(self, text: str) -> Iterator[tuple[int, int]]:
        if text is not None:
            yield from Counter(map(len, text.split(" "))).items()


@F.udtf
class SessionTable:
    """Sessions of a table argument that is partitioned by a key and ordered by time (in microseconds); rows of
    one partition come in order, so only the open session is held. gap is in seconds."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, gap: AnalyzeArgument) -> AnalyzeResult:
        names = rows.dataType.fieldNames() if rows.isTable else []
        if len(names) != 2:
            raise ValueError("sessions() takes a table of a key and a time")
        if not gap.isConstantExpression or gap.value is None or gap.value < 0:
            raise ValueError("the gap must be a constant of 0 or more")
        out = T.StructType().add(names[0], rows.dataType[names[0]].dataType).add("first", T.LongType()).add("last", T.LongType()).add("n", T.LongType())
        return AnalyzeResult(out)

    def __init__(self) -> None:
        self.key, self.first, self.last, self.n = None, None, None, 0

    def eval(self, row: T.Row, gap: int) -> Iterator[tuple]:
        key, at = row
        if self.n and at > self.last + gap * 1_000_000:
            yield self.key, self.first, self.last, self.n
            self.n = 0
        if not self.n:
            self.key, self.first = key, at
        self.last, self.n = at, self.n + 1

    def terminate(self) -> Iterator[tuple]:
        if self.n:
            yield self.key, self.first, self.last, self.n


@F.arrow_udtf(returnType="doc_id long, length long, n long")
class TokenLengthTable:
    """TokenLengths over a table argument (doc_id, text), on Arrow batches."""

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        parts = pc.split_pattern(rows.column("text"), " ")
        at, lengths = pc.list_parent_indices(parts), pc.utf8_length(pc.list_flatten(parts))
        counted = pa.table({"doc_id": rows.column("doc_id").take(at), "length": pc.cast(lengths, pa.int64())}).group_by(["doc_id", "length"]).aggregate([([], "count_all")])
        yield pa.table({"doc_id": counted["doc_id"], "length": counted["length"], "n": counted["count_all"]})


def centered(df: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """Each value less its group's mean: a grouped map in two steps, so that no group is one task's.

    The means come from partial sums; the map over batches needs no group together."""
    means = df.groupBy(by).agg(F.avg(value).alias("_mean"))

    def shift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "centered": (b[value] - b["_mean"]).round(4)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(by, key, value).join(means, by).mapInPandas(shift, f"{key} {kind}, centered double")


@F.arrow_udf(T.LongType())
def arrow_log_bucket(values: pa.Array) -> pa.Array:
    """log_bucket() on Arrow arrays, without pandas."""
    return pc.cast(pc.floor(pc.log2(pc.add(pc.abs(values), 1.0))), pa.int64())


@F.udf(T.LongType())
def letters_e(text: str | None) -> int | None:
    return None if text is None else text.count("e")


def gaps(events: DataFrame) -> DataFrame:
    """Microseconds since the same user's event before: a grouped map, for groups that fit in a task."""

    def since(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["ts", "event_id"])
        return pd.DataFrame({"event_id": group["event_id"], "gap": (group["ts"].diff() // pd.Timedelta(microseconds=1)).astype("Int64")})

    return events.select("user_id", "event_id", "ts").groupBy("user_id").applyInPandas(since, "event_id long, gap long")


def dearest_orders(orders: DataFrame) -> DataFrame:
    """Each customer's dearest order and number of orders, on Arrow tables."""

    def best(group: pa.Table) -> pa.Table:
        return pa.table({"o_custkey": group.column("o_custkey").slice(0, 1), "dearest": [pc.max(group.column("o_totalprice")).as_py()], "n": [group.num_rows]})

    return orders.select("o_custkey", "o_totalprice").groupBy("o_custkey").applyInArrow(best, "o_custkey long, dearest double, n long")


def paired_counts(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """How many rows each side has of a key (nation, customers, suppliers). Each side is counted before the
    cogroup, so a group is one row a side however many rows its key has."""

    def counted(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("nation")).agg(F.count(F.lit(1)).alias("n"))

    def both(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"nation": [key[0]], "customers": [int(a["n"].sum())], "suppliers": [int(b["n"].sum())]})

    return counted(left, left_key).groupBy("nation").cogroup(counted(right, right_key).groupBy("nation")).applyInPandas(both, "nation int, customers long, suppliers long")
