"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: lower-cased (A-Z) words, shingles of some words, 64 bits; a bit is set where more than half
of the shingles' XXH64 values (seed 42) have it. Distinct fingerprints are linked at Hamming distance
at most the radius: every fingerprint emits all variants within half the radius, variants are shuffled,
and those that collide are verified. For an odd radius one differing bit remains after both halves:
the 64 bits are cut into three parts, and each variant is emitted three times, each time without one
part; two fingerprints within the radius then collide without the part in which the odd bit lies.

Equal fingerprints are merged before anything is emitted, so copies cost one row each. Linked
fingerprints in one collision are passed on as a spanning star instead of as pairs; the rest is
connected components.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other; a
null doc_id gets a row, and is a component id only where no other id is in the component; repeated
rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared
from lumenfold.llm.components import connected_components

SEED = 42
#: Bytes of a text that are cut into words at once.
CHUNK_BYTES = 4 << 20
_space = re.compile(rb"[\x20\x09-\x0D]").search
#: Above so many members a collision is searched by variants rather than by comparing its members.
SMALL = 64
#: Variants for a task of the collision stage.
VARIANTS_A_TASK = 4_000_000


def _full(tokens: list[bytes], words: int) -> np.ndarray:
    """The hashes of all runs of so many tokens."""
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(tokens) - words + 1
    cuts = map(slice, starts[:n].tolist(), ends[words - 1 :].tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, n)


def shingles(text: bytes, words: int) -> np.ndarray:
    """The shingles' hashes, in order; a text of fewer words is one shingle, one without words none.

    Long texts are cut into words some MB at a time."""
    out, carry, at = [], [], 0
    while at < len(text):
        end = at + CHUNK_BYTES
        gap = _space(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        tokens = carry + text[at:end].lower().split()
        at = end
        if len(tokens) >= words:
            out.append(_full(tokens, words))
            carry = tokens[len(tokens) - words + 1 :]
        else:
            carry = tokens
    if out:
        return out[0] if len(out) == 1 else np.concatenate(out)
    return np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)] if carry else [], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of a text's shingle hashes."""
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 64):
        part = hashes[at : at + 255 * 64]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(part) // 255 * 255
        if whole:  # sums of 255 bits fit in a byte
            votes += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        votes += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(shingles(t.as_py() or b"", words)) for t in texts), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
        shared.trim()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(compute, "doc_id long, fp long")


def _masks(radius: int) -> list[int]:
    """What each emission leaves out: nothing for an even radius, a third of the bits for an odd one."""
    if radius % 2 == 0:
        return [0]
    bounds = (0, 21, 42, 64)
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:])]


def flips(radius: int, allowed: int = (1 << 64) - 1) -> np.ndarray:
    """All words of at most radius set bits, within the allowed bits."""
    bits = [1 << i for i in range(64) if allowed >> i & 1]
    return np.array([sum(c) for k in range(radius + 1) for c in combinations(bits, k)], np.uint64)


def _emit(radius: int, buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [(np.uint64(~m & (1 << 64) - 1), flips(radius // 2, ~m & (1 << 64) - 1), np.uint64(i)) for i, m in enumerate(_masks(radius))]
        step = max(1, 2_000_000 // sum(len(b) for _, b, _ in balls))
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), step):
                part = fps[at : at + step]
                keys = np.concatenate([blobs.mix(((part & keep)[:, None] ^ ball).ravel() + tag) for keep, ball, tag in balls])
                owners = np.concatenate([np.repeat(part, len(ball)) for _, ball, _ in balls])
                rows = [(i, blobs.pack(k, o)) for i, (k, o) in blobs.cut((keys % np.uint64(buckets)).astype(np.int32), keys, owners)]
                yield blobs.batch(rows)
        shared.trim()

    return emit


def _stars(groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of s members each -> a star for each set of members that links connect."""
    m, s = groups.shape
    linked = np.bitwise_count(groups[:, :, None] ^ groups[:, None, :]) <= radius
    label = np.tile(np.arange(s, dtype=np.int16), (m, 1))
    while True:
        new = np.where(linked, label[:, None, :], np.int16(s)).min(axis=2)
        if (new == label).all():
            break
        label = new
    row, col = np.nonzero(label != np.arange(s))
    return groups[row, col], groups[row, label[row, col]]


def _large_group(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among many members in time proportional to their number.

    All that share a variant within half the radius are within the radius of each other. What an odd
    radius leaves are links between fingerprints of unlike parity: those of odd parity look up their
    variants of one bit more among those that the even ones emitted."""
    half = radius // 2
    ball = flips(half)
    us, vs = [], []
    keys = (members[:, None] ^ ball).ravel()
    owners = np.repeat(members, len(ball))
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    head = owners[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    us.append(owners[~first])
    vs.append(head[~first])
    if radius % 2:
        even = np.bitwise_count(owners) % 2 == 0
        known, known_by = keys[even], owners[even]
        wider = flips(half + 1)
        odd = members[np.bitwise_count(members) % 2 == 1]
        for at in range(0, len(odd) if len(known) else 0, 500):
            probe = (odd[at : at + 500, None] ^ wider).ravel()
            place = np.searchsorted(known, probe)
            place[place == len(known)] = 0
            hit = known[place] == probe
            us.append(np.repeat(odd[at : at + 500], len(wider))[hit])
            vs.append(known_by[place[hit]])
    return np.concatenate(us), np.concatenate(vs)


def _verify(radius: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [blobs.unpack(x.as_py()) for b in batches for x in b.column(1)]
        if not parts:
            return
        keys, owners = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        del parts
        order = np.argsort(keys)
        keys, owners = keys[order], owners[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        us, vs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for s in np.unique(sizes[sizes > 1]).tolist():
            at = starts[sizes == s]
            step = max(1, 2_000_000 // (s * s)) if s <= SMALL else 1
            for i in range(0, len(at), step):
                groups = owners[at[i : i + step, None] + np.arange(s)]
                u, v = _stars(groups, radius) if s <= SMALL else _large_group(np.unique(groups), radius)
                us.append(u)
                vs.append(v)
        u, v = np.concatenate(us), np.concatenate(vs)
        u, v = np.maximum(u, v), np.minimum(u, v)
        pairs = np.unique(np.stack([u, v], axis=1)[u != v], axis=0) if len(u) else np.zeros((0, 2), np.uint64)
        pairs = np.ascontiguousarray(pairs).view(np.int64)
        for i in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[i : i + 100_000, 0]), pa.array(pairs[i : i + 100_000, 1])], ["u", "v"])
        del keys, owners, us, vs, u, v, pairs
        shared.trim()

    return verify


def fingerprint_links(spark: SparkSession, fps: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) whose components are those of all links within the radius."""
    emitted = sum(len(flips(radius // 2, ~m & (1 << 64) - 1)) for m in _masks(radius))
    buckets = max(shared.partitions(spark), -(-fps.count() * emitted // VARIANTS_A_TASK))
    spread = fps.select("fp").mapInArrow(_emit(radius, buckets), blobs.SCHEMA)
    return blobs.deal(spread, buckets).select("bucket", "blob").mapInArrow(_verify(radius), "u long, v long")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id: least doc_id reachable over links)."""
    rows = shared.write_table(spark, with_fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = shared.write_table(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(spark, fingerprint_links(spark, nodes, radius))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    components = joined.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(components, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
