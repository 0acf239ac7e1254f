"""Exact set-similarity self-join by prefix, length and positional filters.

Tokens have one order for all sets: those that a sample finds in many sets come last, by rising count, the
others first, by hash. Any order gives the same pairs; this one keeps frequent tokens out of the prefixes.
Two sets with a Jaccard similarity of t or more share a token among the first n - ceil(t n) + 1 of each, so
only sets that meet in these prefixes are looked at, and of those only pairs whose sizes, and the places of
the token they met by, leave room for enough common tokens.

Disk is what such a join runs out of, so no row is sent for a token or a pair. Prefixes are stored as 5 bytes
of each token's hash and sent packed, by buckets of hashes; pairs that meet leave a bucket packed, by cells (two
blocks that ids are dealt to), where each set is a parity sketch of one to two bits a token: two sketches differ in
no more bits than the sets in tokens, so a pair whose sketches differ in too many is none. What remains, seldom
more than the links, is verified on the whole sets, which are made again for it. Short hashes and sketches
only decide what is verified, never what is a link.

Equal sets are one class, with their least id for all; links are between classes, so copies cost one row.
Tokens are compared as 64-bit hashes. Sets without tokens, and null ids, are in no class and no link."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.sources.tables import scratch_path


def split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def shingles(text: Column, words: int) -> Column:
    """All runs of so many words, space-joined; of a shorter text the whole; none of a blank one."""
    w = split(text)
    columns = [F.slice(w, i + 1, F.greatest(F.size(w) - words + 1, F.lit(0))) for i in range(words)]
    runs = F.transform(F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(columns)]), lambda x: F.concat_ws(" ", *[x[f"w{i}"] for i in range(words)]))
    return F.when(F.size(w) >= words, runs).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))


def token_sets(docs: DataFrame, tokens: Column, id_col: str) -> DataFrame:
    """(id, tokens: hashes of the tokens; a join takes them as a set, or their runs)."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.transform(tokens, lambda t: F.xxhash64(t)).alias("tokens")).where("id IS NOT NULL")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(**columns: np.ndarray) -> bytes:
    """The first column, best in rising order, as differences."""
    first, *others = columns.values()
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (np.diff(first, prepend=np.int64(0)), *others)], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> list[np.ndarray]:
    first, *others = (c.to_numpy() for c in pa.ipc.open_stream(blob).read_all().columns)
    return [np.cumsum(first), *others]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one after another."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def token_runs(values: np.ndarray, n: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of so many of each list's values, of a shorter list one of the whole; and how many."""
    if words == 1:
        return values, n
    v = np.append(values, np.zeros(words, np.int64)).view(np.uint64)
    count, length = np.where(n >= words, n - words + 1, np.minimum(n, 1)), np.minimum(n, words)
    at = spans(np.cumsum(n) - n, count)
    length = np.repeat(length, count)
    h = length.astype(np.uint64)
    for i in range(words):
        x = (h ^ v[at + i]) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = np.where(i < length, x ^ (x >> np.uint64(29)), h)
    return h.view(np.int64), count


def listed(b: pa.RecordBatch, words: int, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, sizes, distinct tokens in rising order) of sets that have tokens, about so many tokens at a time."""
    b = b.filter(pc.fill_null(pc.greater(pc.list_value_length(b.column("tokens")), 0), False))
    ids, lengths = b.column("id").to_numpy(zero_copy_only=False), b.column("tokens").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(lengths) - lengths) // most)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
        if hi > lo:
            values, n = token_runs(b.column("tokens").slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False), lengths[lo:hi], words)
            owner = np.repeat(np.arange(hi - lo), n)
            order = np.lexsort((values, owner))
            values, owner = values[order], owner[order]
            new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))
            yield ids[lo:hi], np.bincount(owner[new], minlength=hi - lo), values[new]


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of a sketch of so many tokens: a power of two, so that it can be folded to fewer bits."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def sketches(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bytes of all sketches, one after another: a bit is the parity of the tokens that fall on it."""
    bits = sketch_bits(n)
    at = np.repeat(np.cumsum(bits) - bits, n) + (values & np.repeat(bits - 1, n))
    return np.packbits((np.bincount(at, minlength=bits.sum()) & 1).astype(np.uint8), bitorder="little")


def folded(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


#: One set in so many is in the sample; a token in so many sets of it is frequent, as long as there are not more
#: than so many of them. Ids that are sent to all tasks, at most. Entries of a bucket; entries or pairs that are
#: packed or compared at once. Blocks of ids at least, and bytes of a block's sketches and of its whole sets.
SAMPLE, OFTEN, FREQUENT, SENT = 32, 3, 200_000, 1_000_000
ENTRIES, AT_ONCE, BLOCKS, SKETCH_BYTES, BLOCK_BYTES = 1 << 20, 1 << 19, 5, 64 << 20, 32 << 20

#: Bytes of a token's hash in a prefix.
SHORT = 5


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    h = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(blocks)).astype(np.int64)


class Sketched:
    """The sketches of a cell's sets; which pairs of ids may be links."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, data: np.ndarray, threshold: float):
        order = np.argsort(ids, kind="stable")
        words = sketch_bits(n) // 64
        self.ids, self.n, self.words, self.at = ids[order], n[order], words[order], (np.cumsum(words) - words)[order]
        self.data, self.threshold = data.view(np.uint64), threshold

    def _rows(self, of: np.ndarray, words: int) -> np.ndarray:
        return self.data[self.at[of][:, None] + np.arange(words)]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = np.searchsorted(self.ids, a), np.searchsorted(self.ids, b)
        total = self.n[x] + self.n[y]
        most = total - 2 * np.ceil(self.threshold / (1 + self.threshold) * total - 1e-9).astype(np.int64)
        kept = np.zeros(len(a), bool)
        kinds = self.words[x] * (1 << 32) + self.words[y]
        for kind in np.unique(kinds).tolist():
            these, wx, wy = np.flatnonzero(kinds == kind), kind >> 32, kind & 0xFFFFFFFF
            step = max(1, AT_ONCE // max(wx, wy))
            for i in range(0, len(these), step):
                t = these[i : i + step]
                differ = folded(self._rows(x[t], wx), min(wx, wy)) ^ folded(self._rows(y[t], wy), min(wx, wy))
                kept[t] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most[t]
        return kept


def pairs_that_meet(ids: np.ndarray, n: np.ndarray, at: np.ndarray, token: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b: the larger set) of entries with one token that pass the filters, so many at a time, each once a time."""
    order = np.lexsort((ids, n, token))
    ids, n, at, token = ids[order], n[order], at[order], token[order]
    group = np.cumsum(np.append(0, token[1:] != token[:-1])) if len(token) else token
    key = group << 32 | n
    end = np.searchsorted(key, group << 32 | np.floor(n / threshold + 1e-6).astype(np.int64), side="right")
    least = n - np.ceil(threshold / (1 + threshold) * 2 * n - 1e-9).astype(np.int64) + 1  # the smaller set's place
    partners = np.where(at <= least, end - np.arange(len(n)) - 1, 0)
    smaller = np.flatnonzero(partners > 0)
    smaller = smaller[np.argsort(ids[smaller], kind="stable")]  # one set's pairs together, so that they are told apart here
    cumulated = np.cumsum(partners[smaller])
    total = int(cumulated[-1]) if len(cumulated) else 0
    for lo in range(0, total, AT_ONCE):
        hi = min(total, lo + AT_ONCE)
        first, last = np.searchsorted(cumulated, lo, side="right"), np.searchsorted(cumulated, hi - 1, side="right") + 1
        of = smaller[first:last]
        before = np.append(0, cumulated)[first:last]
        skip, stop = np.maximum(lo - before, 0), np.minimum(cumulated[first:last], hi) - before
        a = np.repeat(of, stop - skip)
        b = spans(of + 1 + skip, stop - skip)
        need = np.ceil(threshold / (1 + threshold) * (n[a] + n[b]) - 1e-9).astype(np.int64)
        room = np.minimum(n[a] - at[a], n[b] - at[b]) + np.minimum(at[a], at[b])
        good = (ids[a] != ids[b]) & (n[a] >= np.ceil(threshold * n[b] - 1e-9)) & (at[a] <= n[a] - need + 1) & (at[b] <= n[b] - need + 1) & (room >= need)
        left, right = np.minimum(ids[a], ids[b])[good], np.maximum(ids[a], ids[b])[good]
        yield distinct(left, right)


def distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[: len(left)]
    return left[new], right[new]


def dealt(part: np.ndarray, **columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows packed by part, in their order."""
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.diff(part[order], prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(part)]):
        yield int(part[order[lo]]), packed(**{k: c[order[lo:hi]] for k, c in columns.items()})


class Join:
    """The parts of one join: members (id, class_id), candidates and links between classes. Sets are of runs of
    so many of the listed tokens."""

    def __init__(self, spark: SparkSession, sets: DataFrame, threshold: float, words: int = 1):
        self.spark, self.sets, self.threshold, self.words = spark, sets, threshold, words
        keyed = stored(spark, self._prefixes(), "prefixes")
        least = F.min("id").alias("class_id")
        keys = keyed.select("id", "digest")
        self.members = stored(spark, keys.join(keys.groupBy("digest").agg(least), "digest").select("id", "class_id"), "members")
        # Equal sets have the same size, prefix and sketch.
        self.classes = stored(spark, keyed.groupBy("digest").agg(least, *[F.first(c).alias(c) for c in ("n", "prefix", "sketch")]).withColumnRenamed("class_id", "id"), "classes")
        several = self.classes.groupBy("id").agg(F.count(F.lit(1)).alias("sets"), F.min("digest").alias("own")).where("sets > 1").select("id", "own")
        if several.limit(1).count():  # an id may have several sets, of which one is the class
            self.classes = stored(spark, self.classes.join(several, "id", "left").where("own IS NULL OR own = digest").drop("own"), "classes")
        self.candidates = stored(spark, self._candidates(), "candidates")
        self.links = stored(spark, self._verified(), "links")

    def _frequent(self) -> list[int]:
        words = self.words

        def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for _, _, values in listed(b, words):
                    yield pa.RecordBatch.from_arrays([pa.array(values)], ["token"])

        sample = self.sets.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).mapInArrow(tokens, "token long")
        often = sample.groupBy("token").count().where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "token").limit(FREQUENT)
        return [r[0] for r in often.select("token").collect()]

    def _prefixes(self) -> DataFrame:
        """(id, digest of the set, n, prefix: short hashes, sketch)."""
        tokens = np.array(self._frequent(), np.int64)[::-1]
        by_token = np.argsort(tokens)
        sent = self.spark.sparkContext.broadcast((tokens[by_token], by_token + 1))
        threshold, words = self.threshold, self.words

        def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, place = sent.value
            for b in batches:
                for ids, n, values in listed(b, words):
                    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
                    rank = np.where(known[at] == values, place[at], 0) if len(known) else np.zeros(len(values), np.int64)
                    order = np.lexsort((values, rank, np.repeat(np.arange(len(n)), n)))
                    starts, length = np.cumsum(n) - n, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
                    short = values[order][spans(starts, length)].view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()
                    drawn, size = sketches(values, n).tobytes(), sketch_bits(n) // 8
                    digests = [hashlib.sha256(values[i : i + k].tobytes()).digest()[:16] for i, k in zip(starts.tolist(), n.tolist())]
                    cut = lambda data, sizes: pa.array([data[e - k : e] for e, k in zip(np.cumsum(sizes).tolist(), sizes.tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(digests, pa.binary()), pa.array(n, pa.int32()), cut(short, length * SHORT), cut(drawn, size)], ["id", "digest", "n", "prefix", "sketch"])

        return self.sets.mapInArrow(prefixes, "id long, digest binary, n int, prefix binary, sketch binary")

    def _candidates(self) -> DataFrame:
        """(a_id, b_id) of classes that meet and whose sketches are near."""
        tokens, count = self.classes.agg(F.sum("n"), F.count(F.lit(1))).first()
        entries = (1 - self.threshold) * (tokens or 0) + 2 * count
        buckets, threshold = math.ceil(entries / ENTRIES) or 1, self.threshold
        blocks = max(BLOCKS, math.ceil((0.2 * (tokens or 0) + 32 * count) / SKETCH_BYTES))

        def entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def out() -> pa.RecordBatch:
                ids, n, at, token = (np.concatenate(c) for c in zip(*held))
                order = np.argsort(ids, kind="stable")
                ids, n, at, token = ids[order], n[order], at[order], token[order]
                rows = dealt(token % buckets, id=ids, n=n, at=at, low=(token // buckets).astype(np.uint32), high=(token // buckets >> 32).astype(np.uint8))
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary()))], ["part", "blob"])

            for b in batches:
                n = b.column("n").to_numpy(zero_copy_only=False).astype(np.int32)
                length = b.column("prefix").cast(pa.large_binary())
                data = np.frombuffer(b"".join(length.to_pylist()), np.uint8).reshape(-1, SHORT)
                length = pc.binary_length(length).to_numpy(zero_copy_only=False) // SHORT
                token = np.zeros((len(data), 8), np.uint8)
                token[:, :SHORT] = data
                held.append((np.repeat(b.column("id").to_numpy(zero_copy_only=False), length), np.repeat(n, length), (spans(np.zeros(len(n), np.int64), length) + 1).astype(np.int32), token.view(np.int64)[:, 0]))
                size += len(data)
                if size >= 2 * AT_ONCE:
                    yield out()
                    held, size = [], 0
            if size:
                yield out()

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = [unpacked(x) for b in batches for x in b.column("blob").to_pylist()]
            if got:
                ids, n, at, low, high = (np.concatenate(c) for c in zip(*got))
                del got
                token = low.astype(np.int64) | high.astype(np.int64) << 32
                for left, right in pairs_that_meet(ids, n.astype(np.int64), at.astype(np.int64), token, threshold):
                    if len(left):
                        x, y = block_of(left, blocks), block_of(right, blocks)
                        rows = dealt(np.minimum(x, y) * blocks + np.maximum(x, y), left=left, right=right - left)
                        cells, blobs = zip(*rows)
                        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array([1] * len(cells), pa.int32()), pa.array(blobs, pa.binary())], ["cell", "kind", "blob"])

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = block_of(b.column("id").to_numpy(zero_copy_only=False), blocks)
                for x in np.unique(block).tolist():
                    some = b.filter(pa.array(block == x))
                    sizes = packed(id=some.column("id").to_numpy(zero_copy_only=False), n=some.column("n").to_numpy(zero_copy_only=False))
                    blob = len(sizes).to_bytes(8, "little") + sizes + b"".join(some.column("sketch").to_pylist())
                    for cell in (min(x, y) * blocks + max(x, y) for y in range(blocks)):
                        yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([0], pa.int32()), pa.array([blob], pa.binary())], ["cell", "kind", "blob"])

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, drawn, sketched, found = None, [], None, []

            def out() -> Iterator[pa.RecordBatch]:
                if found:
                    left, right = distinct(*(np.concatenate(c) for c in zip(*found)))
                    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a_id", "b_id"])

            for b in batches:
                for c, kind, blob in zip(*(b.column(x) for x in ("cell", "kind", "blob"))):
                    if c.as_py() != cell:
                        yield from out()
                        cell, drawn, sketched, found = c.as_py(), [], None, []
                    blob = blob.as_py()
                    if kind.as_py() == 0:
                        size = int.from_bytes(blob[:8], "little")
                        drawn.append((*unpacked(blob[8 : 8 + size]), np.frombuffer(blob[8 + size :], np.uint8)))
                        continue
                    if sketched is None:
                        ids, n, data = (np.concatenate(x) for x in zip(*drawn))
                        sketched, drawn = Sketched(ids, n.astype(np.int64), data, threshold), []
                    left, right = unpacked(blob)
                    right = left + right
                    kept = sketched.near(left, right)
                    if kept.any():
                        found.append((left[kept], right[kept]))
                        if sum(len(x) for x, _ in found) > 8 * AT_ONCE:  # pairs that come again are told apart when verified
                            yield from out()
                            found = []
            yield from out()

        sent = self.classes.select("id", "n", "prefix").mapInArrow(entries_of, "part int, blob binary").repartitionById(buckets, F.col("part"))
        met = sent.select("blob").mapInArrow(meet, "cell int, kind int, blob binary")
        drawn = self.classes.select("id", "n", "sketch").mapInArrow(draw, "cell int, kind int, blob binary")
        return met.union(drawn).repartitionById(blocks * blocks, F.col("cell")).sortWithinPartitions("cell", "kind").mapInArrow(near, "a_id long, b_id long")

    def _verified(self) -> DataFrame:
        ends = self.candidates.select(F.explode(F.array("a_id", "b_id")).alias("id")).distinct()
        needed = stored(self.spark, ends.join(self.classes.select("id", "digest", "n"), "id"), "needed")
        count, tokens = needed.agg(F.count(F.lit(1)), F.sum("n")).first()
        blocks = max(BLOCKS, math.ceil(8 * (tokens or 0) / BLOCK_BYTES), math.ceil(math.sqrt(2 * self.candidates.count() / AT_ONCE)))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
        cell = F.least(block("a_id"), block("b_id")) * blocks + F.greatest(block("a_id"), block("b_id"))
        pairs = self.candidates.withColumn("cell", cell)
        cells = pairs.select(F.explode(F.array("a_id", "b_id")).alias("id"), "cell").groupBy("id").agg(F.collect_set("cell").alias("cells"))
        places = cells.join(needed.select("id", F.col("digest").alias("own")), "id")
        whole = self.sets.join(F.broadcast(places) if count <= SENT else places, "id")
        threshold, words = self.threshold, self.words

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pc.fill_null(pc.greater(pc.list_value_length(b.column("tokens")), 0), False))
                at = 0
                for ids, n, values in listed(b, words):
                    own, to = (b.column(c).slice(at, len(ids)).to_pylist() for c in ("own", "cells"))
                    at += len(ids)
                    rows = []
                    for i, e, k, digest, spots in zip(ids.tolist(), np.cumsum(n).tolist(), n.tolist(), own, to):
                        data = values[e - k : e].tobytes()
                        if hashlib.sha256(data).digest()[:16] == digest:
                            rows += [(s, i, data) for s in spots]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["spot", "id", "data"])

        def verify(pairs: pa.Table, sets: pa.Table) -> pa.Table:
            held = {i: np.frombuffer(data.as_buffer(), np.int64) for i, data in zip(sets["id"].to_pylist(), sets["data"])}
            left, right = distinct(pairs["a_id"].to_numpy(), pairs["b_id"].to_numpy())
            shared, total = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
            for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
                x, y = held[a], held[b]
                shared[i] = np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y)
                total[i] = len(x) + len(y) - shared[i]
            links = shared >= threshold * total - 1e-9
            return pa.table({"left_id": left[links], "right_id": right[links], "shared": shared[links], "total": total[links]})

        placed = whole.mapInArrow(made, "spot long, id long, data binary")
        return pairs.groupBy("cell").cogroup(placed.groupBy("spot")).applyInArrow(verify, "left_id long, right_id long, shared long, total long")

    def by_document(self) -> DataFrame:
        """(id, class_id, n_links: classes that are similar to its own)."""
        ends = self.links.select(F.explode(F.array("left_id", "right_id")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
        return self.members.join(ends, "class_id", "left").select("id", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
