"""Stateful processors: several states a key, event-time timers, and state that expires, kept in RocksDB.

State is on the executors' disks with a copy of each version in the checkpoint folder, so a key's state may
be larger than memory and survives lost executors.

The key is a bucket of users, not a user: every key costs a batch some calls between Python and the JVM,
whatever it holds, so a bucket's rows are worked on as columns and its state is kept packed, as Arrow
batches. The number of calls then depends on the buckets, not on the users; a task holds one bucket's open
rows at a time."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys of state that users are dealt to. Part of what a checkpoint holds: a stream keeps the number that it began with.
BUCKETS = 128

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which these processors need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def by_bucket(events: DataFrame, *columns: str):
    """events grouped by bucket, with these columns, user (no null: known says whether there is one) and bucket."""
    return events.select(
        *columns, F.coalesce("user_id", F.lit(0)).cast("long").alias("user"), F.col("user_id").isNotNull().alias("known"), F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket")
    ).groupBy("bucket")


def pack(rows: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def unpack(packed: list[bytes]) -> pd.DataFrame:
    return pa.concat_tables([pa.ipc.open_stream(bytes(p)).read_all() for p in packed], promote_options="permissive").to_pandas()


def users(rows: pd.DataFrame) -> pd.Series:
    """The column user_id again, with its nulls."""
    return rows["user"].astype("Int64").where(rows["known"])


SESSION = "user_id long, start timestamp, end timestamp, n long, total double, kinds long, views long"
PACKED = T.StructType().add("rows", T.BinaryType())
USER = ["known", "user"]


class Sessions(StatefulProcessor):
    """Users' sessions: events not more than a gap apart. A session is emitted when an event-time timer
    finds that the watermark has passed its last event by more than the gap; late events before that
    extend, start or merge sessions, as all events of open sessions are kept.

    List state: the events of open sessions. Map state: the number of each user's events by kind, of all
    sessions that were closed. Value state: the time that the next timer is set to."""

    def __init__(self, gap_seconds: int):
        self.gap = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", PACKED)
        self.closed = handle.getMapState("closed", T.StructType().add("kind", T.StringType()), PACKED)
        self.timer = handle.getValueState("timer", T.StructType().add("at", T.LongType()))

    def _next_timer(self, end: int) -> None:
        new = end // 1000 + 1
        self.handle.registerTimer(new)
        self.timer.update((new,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """One timer a key, for when a session may close at the earliest: no session ends before its first event's gap."""
        ends = []
        for b in rows:
            self.open.appendValue((pack(b[[*USER, "at", "value", "event_type"]]),))
            ends.append(int(b["at"].min()) + self.gap)
        old = self.timer.get()[0] if self.timer.exists() else None
        if old is None or min(ends) // 1000 + 1 < old:
            if old is not None:
                self.handle.deleteTimer(old)
            self._next_timer(min(ends))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()  # the expired timer is gone by itself
        events = unpack([x[0] for x in self.open.get()]).sort_values([*USER, "at"], ignore_index=True)
        fresh = (events[USER] != events[USER].shift()).any(axis=1) | (events["at"].diff() > self.gap)
        session = fresh.cumsum()
        end = events.groupby(session)["at"].transform("max") + self.gap
        over = end < watermark
        if over.all():
            self.open.clear()
        else:
            self._next_timer(int(end[~over].min()))
            if over.any():
                self.open.put([(pack(events[~over]),)])
        if not over.any():
            yield pd.DataFrame()
            return
        events["view"] = events["event_type"] == "view"
        made = events[over].groupby(session[over]).agg(known=("known", "first"), user=("user", "first"), start=("at", "min"), end=("at", "max"), n=("at", "size"), kinds=("event_type", "nunique"), views=("view", "sum"))
        made["total"] = events[over].groupby(session[over])["value"].sum(min_count=1).astype(float)
        seen = self._close(events[over])
        made["views"] = made.groupby(USER)["views"].cumsum() + (seen.reindex(pd.MultiIndex.from_frame(made[USER])).fillna(0).astype(np.int64).to_numpy() if len(seen) else 0)
        made["user_id"] = users(made)
        for c, shift in (("start", 0), ("end", self.gap)):
            made[c] = pd.to_datetime(made[c] + shift, unit="us", utc=True)
        yield made[[x.split()[0] for x in SESSION.split(", ")]].reset_index(drop=True)

    def _close(self, events: pd.DataFrame) -> pd.Series:
        """Adds the events to the map; the views that it had of each user before."""
        before = pd.Series(dtype=np.int64)
        for kind, rows in events.groupby("event_type"):
            counts = rows.groupby(USER).size()
            if self.closed.containsKey((kind,)):
                old = unpack([self.closed.getValue((kind,))[0]]).set_index(USER)["n"]
                before = old if kind == "view" else before
                counts = counts.add(old, fill_value=0).astype(np.int64)
            self.closed.updateValue((kind,), (pack(counts.rename("n").reset_index()),))
        if not (events["event_type"] == "view").any() and self.closed.containsKey(("view",)):
            before = unpack([self.closed.getValue(("view",))[0]]).set_index(USER)["n"]
        return before

    def close(self) -> None:
        pass


def timed_sessions(events: DataFrame, gap_seconds: int, late: str) -> DataFrame:
    """(user_id, start, end, n, total, kinds: different types in the session, views: the user's views in all
    sessions up to this one)."""
    marked = by_bucket(events.withWatermark("ts", late).withColumn("at", F.unix_micros("ts")), "ts", "at", "value", "event_type")
    return marked.transformWithStateInPandas(Sessions(gap_seconds), SESSION, "append", "eventTime")


class FirstSeen(StatefulProcessor):
    """The first event of each kind for a user; what was seen is forgotten after a time to live (processing time).

    List state: for each batch the pairs that it met first; they expire together, as they were seen together."""

    PAIR = [*USER, "typed", "kind"]

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", PACKED, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = pd.concat([b.groupby(self.PAIR)["event_id"].min() for b in rows]).groupby(level=self.PAIR).min()
        packed = [x[0] for x in self.seen.get()] if self.seen.exists() else []
        if packed:
            first = first[~first.index.isin(pd.MultiIndex.from_frame(unpack(packed)))]
        new = first.reset_index()
        if not len(new):
            yield pd.DataFrame()
            return
        self.seen.appendValue((pack(new[self.PAIR]),))
        # Strings as objects: pandas' own string arrays don't pass as one Arrow array.
        yield pd.DataFrame({"user_id": users(new), "event_type": new["kind"].astype(object).where(new["typed"], None), "event_id": new["event_id"]})

    def close(self) -> None:
        pass


def first_seen(events: DataFrame, ttl_ms: int) -> DataFrame:
    """(user_id, event_type, event_id): each pair's first event in the batch that met it first, or met it
    first since it was forgotten."""
    kinds = {"kind": F.coalesce("event_type", F.lit("")), "typed": F.col("event_type").isNotNull()}
    return by_bucket(events.withColumns(kinds), "event_id", "kind", "typed").transformWithStateInPandas(FirstSeen(ttl_ms), "user_id long, event_type string, event_id long", "append", "processingTime")
