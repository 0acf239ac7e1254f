"""Importance resampling towards a target distribution over hashed runs of words.

Words are runs of digits, letters and characters beyond ASCII, after lower-casing A-Z. Features are all
runs of 1 to n words, joined by one space, hashed by CRC-32 into buckets. A streaming ring scans a text
once: it keeps the CRC state of the run of 1, 2, .. n words that ends at the last word, and each next word
extends every state by a space and itself; the states are the features' hashes, so no run of words is
ever put together. Texts are read in pieces, and the ring carries over from one to the next.

A bucket's gain is the log ratio of its smoothed share in the target and in the documents, in thousandths,
rounded down; a document's weight is the sum of gains over its features. Gumbel noise from a hash of the id
is added, and of the documents with enough words the best share is drawn, which is a draw without
replacement in proportion to the weights' exponentials.

The scan's buckets are stored once (sorted, as differences, compressed), so that counting and scoring don't
scan the texts again. What the driver gets is one count for each bucket and one for each partition of the
ranking; ranks come from a range partitioning and prefix sums, with no global window.

Defined results: null, empty and wordless texts have no features, weight 0, and are never drawn if
min_words is 1 or more; a null doc_id is hashed as the empty string and comes last among ties; rows of
equal score and doc_id are ranked in some order that is stable within a run (all rows get a rank of their
own); an empty target has T = 0; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared

GRAMS, BUCKETS, SEED = 3, 10_000, 42
MIN_WORDS, SHARE = 20, 5
#: Bytes of a text that are cut into words at once.
CHUNK_BYTES = 4 << 20
#: Rows for a task of the ranking.
RANK_ROWS = 1_000_000
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some MB at a time."""
    at = 0
    while at < len(text):
        part = text[at : at + CHUNK_BYTES].translate(_LETTERS)
        at += len(part)
        while at < len(text) and part[-1] != 32:  # up to the end of the word that the piece cuts
            more = text[at : at + 64].translate(_LETTERS)
            end = more.find(b" ")
            more = more if end < 0 else more[: end + 1]
            part, at = part + more, at + len(more)
        if words := part.split():
            yield words


def ring(text: bytes, grams: int = GRAMS) -> Iterator[tuple[int, list[int]]]:
    """(words in a run, CRC-32 of runs of that many words), piece by piece and for each length."""
    last: list[int | None] = [None] * grams  # the state of the run of k + 1 words that ends at the last word
    for words in _pieces(text):
        states = list(map(zlib.crc32, words))
        extend = [b" " + w for w in words]
        first = 0  # the first word of the piece at which a run of this length ends
        for k in range(grams):
            if k:
                if last[k - 1] is None:
                    first += 1
                    longer = list(map(zlib.crc32, extend[first:], states))
                else:
                    first = 0
                    longer = list(map(zlib.crc32, extend, [last[k - 1], *states]))
                last[k - 1], states = states[-1] if states else last[k - 1], longer
            yield k + 1, states
        last[grams - 1] = states[-1] if states else last[grams - 1]


def features(text: bytes, grams: int = GRAMS, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the buckets of all features in rising order, repeats included."""
    words, parts = 0, [np.zeros(0, np.uint32)]
    for k, states in ring(text, grams):
        words += len(states) if k == 1 else 0
        parts.append(np.fromiter(states, np.uint32, len(states)) % np.uint32(buckets))
    return words, np.sort(np.concatenate(parts))


def _store(sorted_buckets: np.ndarray) -> bytes:
    """Differences as byte planes: nearly all bytes of the upper planes are zero."""
    steps = np.diff(sorted_buckets, prepend=np.uint32(0)).astype("<u4")
    return blobs.pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _load(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blobs.unpack(blob)[0], np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def scan(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, stored: the features' buckets)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).cast(pa.binary()):
                words, found = features(text.as_py() or b"", grams, buckets)
                rows.append((words, len(found), _store(found)))
            ns, ms, stored = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(ms, pa.int64()), pa.array(stored, pa.binary())], ["doc_id", "n_words", "n_features", "stored"])
        shared.trim()

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(each, "doc_id long, n_words long, n_features long, stored binary")


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table fall into each bucket; tasks send one sum for each bucket."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for blob in b.column(0):
                total += np.bincount(_load(blob.as_py()), minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in scanned.select("stored").mapInArrow(partial, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """By bucket: the log ratio of the smoothed shares in thousandths, rounded down."""
    buckets, every, some = len(corpus), float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratios = ((t + 1.0) * every / ((s + 1.0) * some) for t, s in zip(target.tolist(), corpus.tolist()))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratios), np.int64, buckets)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(scanned: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights = [int(gain[_load(x.as_py())].sum()) for x in b.column(3)]
            scores = [w + noise(i, seed) for w, i in zip(weights, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], ["doc_id", "n_words", "n_features", "weight", "score"])

    return scanned.select("doc_id", "n_words", "n_features", "stored").mapInArrow(each, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(spark: SparkSession, rows: DataFrame, n: int, most: int) -> DataFrame:
    """rows with rank: 1, 2, 3, .. by falling score, then rising doc_id, null beyond the most."""
    parts = max(shared.partitions(spark), -(-n // RANK_ROWS))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id counts rows from 0 in each partition, which is its upper bits.
    at = F.monotonically_increasing_id()
    stored = shared.write_table(spark, dealt.drop("_row").withColumns({"_part": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}), "ranked")
    sizes = sorted(tuple(r) for r in stored.groupBy("_part").agg((F.max("_at") + 1).alias("n")).collect())
    bases, before = [], 0
    for part, size in sizes:
        bases.append((part, before))
        before += size
    known = F.broadcast(spark.createDataFrame(bases, "_part long, _base long"))  # one row for each partition
    rank = F.col("_base") + F.col("_at") + 1
    return stored.join(known, "_part").withColumn("rank", F.when(rank <= most, rank)).drop("_part", "_at", "_base")


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """Every document as (doc_id, n_words, n_features, weight, score, rank); rank is null for those not drawn.

    share: percent of the documents with at least min_words words that are drawn."""
    scanned = shared.write_table(spark, scan(docs, grams, buckets, id_col, text_col), "features")
    wanted = scan(target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_col).alias("text")), grams, buckets)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(scanned, buckets))
    rows = shared.write_table(spark, scored(scanned, gain, seed), "scored")
    enough = F.col("n_words") >= min_words
    n = rows.where(enough).count()
    return ranked(spark, rows.where(enough), n, share * n // 100).unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))
