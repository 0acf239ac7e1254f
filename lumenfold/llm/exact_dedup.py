"""Exact duplicates by Patricia tries.

Texts are equal when their bytes are, after white space is deleted. Partitions are dealt by length and
content hash; in each, full byte strings are inserted into a compressed radix trie, whose terminal nodes
hold the best row of their text: most code points in the original, then least identifier. Equality is
decided by the trie's edges, never by the hash; a task checks that the texts of one SHA-256 end in one
node, so that decisions can be joined back to rows by it.

Tasks combine copies in a trie of their own before anything is sent. A text that makes up a large share of
all rows or bytes would still arrive from every task: such texts (known from a count, a bounded list) are
dealt into SALTS partitions first, and what these keep is merged in a second round.

A trie that outgrows its memory spills by subtree: the heaviest branch goes to files in the shared folder,
later texts under it are appended there, and it is finished alone, after the rest and by the same means.
So a task's memory is bounded by its limit and the longest text.

Defined results: null, empty and blank texts are one group; a null doc_id loses ties; of rows with equal
text, code points and doc_id exactly one stays; an empty table gives an empty one; other columns, whatever
their names, are ignored by owners() and kept by drop_copies().
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import shared

#: Deleted before texts are compared.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text for a partition; bytes of a trie in which a task combines what it sends, and of one that
#: must not outgrow a task's memory.
PART_BYTES, COMBINE_BYTES, TRIE_BYTES = 32 << 20, 16 << 20, 96 << 20
#: A text with more than this share of all rows or bytes is hot, so that fewer than 2 * HOT_PARTS are.
HOT_PARTS, SALTS = 1024, 64
#: Least bytes of a spill file.
SPILL_BYTES = 16 << 10
#: What a node of a trie takes besides its label.
NODE_BYTES = 400


class Best(NamedTuple):
    """The best row of a text so far. Ids may be null."""

    digest: bytes
    chars: int
    doc_id: int | None
    row: int
    n: int


def better(a: Best, b: Best) -> Best:
    key = lambda x: (-x.chars, x.doc_id is None, x.doc_id or 0, x.row)
    if a.digest != b.digest:
        raise ValueError("one text with two digests")
    return (a if key(a) <= key(b) else b)._replace(n=a.n + b.n)


class Node:
    __slots__ = ("label", "children", "best", "spill")

    def __init__(self, label: bytes, best: Best | None = None):
        self.label, self.best, self.spill = label, best, None
        self.children: dict[int, Node] = {}


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Spill:
    """The texts under one branch: suffixes and their best rows, in files under a path.

    A fork has up to 256 branches, so each may keep that share of the limit waiting."""

    def __init__(self, path: str, most: int):
        self.path, self.most, self.waiting, self.size, self.files = path, most, [], 0, 0
        self.inner: list[tuple[bytes, Spill]] = []  # branches below this one that were spilled before it

    def add(self, suffix: bytes, best: Best) -> None:
        self.waiting.append((suffix, tuple(best)))
        self.size += len(suffix) + 100
        if self.size >= self.most:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            with shared.publish(f"{self.path}/{self.files}") as f:
                f.write(pickle.dumps(self.waiting))
            self.waiting, self.size, self.files = [], 0, self.files + 1

    def read(self) -> Iterator[tuple[bytes, Best]]:
        for i in range(self.files):
            with shared.open_read(f"{self.path}/{i}") as f:
                part = pickle.loads(f.read())
            for suffix, best in part:
                yield suffix, Best(*best)
        yield from ((s, Best(*b)) for s, b in self.waiting)
        for prefix, spill in self.inner:
            yield from ((prefix + s, b) for s, b in spill.read())


class Trie:
    """Byte strings -> best rows. limit: bytes before a branch spills to a folder under the path; None: never."""

    def __init__(self, limit: int | None = None, path: str = ""):
        self.root, self.size, self.limit, self.path, self.spills = Node(b""), 0, limit, path, 0

    def insert(self, text: bytes, best: Best) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], best)
                self.size += len(text) - at + NODE_BYTES
                break
            if not text.startswith(child.label, at):
                same = common(child.label, text[at : at + len(child.label)])
                fork = Node(child.label[:same])
                child.label = child.label[same:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = fork
                self.size += NODE_BYTES
                child = fork
            node, at = child, at + len(child.label)
            if node.spill:
                node.spill.add(text[at:], best)
                return
        else:
            node.best = better(node.best, best) if node.best else best
        if self.limit and self.size > self.limit:
            self._spill()

    def _spill(self) -> None:
        """Move the heaviest branch below the first fork to files."""
        top = self.root
        while len(top.children) == 1 and top.best is None and not (only := next(iter(top.children.values()))).spill:
            top = only
        held = {k: sum(len(n.label) + NODE_BYTES for n, _ in walk(c)) for k, c in top.children.items() if not c.spill}
        if not held:
            return
        branch = top.children[max(held, key=held.__getitem__)]
        branch.spill = Spill(f"{self.path}/{self.spills}", max(SPILL_BYTES, self.limit // 256))
        self.spills += 1
        for node, prefix in walk(branch, b""):
            if node.best:
                branch.spill.add(prefix, node.best)
            elif node.spill and node is not branch:
                branch.spill.inner.append((prefix, node.spill))
        branch.spill.flush()
        self.size -= max(held.values()) - len(branch.label) - NODE_BYTES
        branch.children, branch.best = {}, None

    def finish(self, prefix: bytes = b"") -> Iterator[tuple[bytes, Best]]:
        """All texts with their best rows; branches that were spilled come last, one at a time."""
        later = []
        for node, text in walk(self.root, prefix):
            if node.spill:
                later.append((text, node.spill))
            elif node.best:
                yield text, node.best
        self.root = Node(b"")
        for text, spill in later:
            below = Trie(self.limit, f"{spill.path}/below")
            for suffix, best in spill.read():
                below.insert(suffix, best)
            yield from below.finish(text)


def walk(node: Node, prefix: bytes | None = None) -> Iterator[tuple[Node, bytes | None]]:
    """All nodes from a node down, with their text: prefix for the first one, extended by the labels below."""
    stack = [(node, prefix)]
    while stack:
        at, text = stack.pop()
        yield at, text
        stack += [(c, None if text is None else text + c.label) for c in at.children.values()]


ROW = "row long, doc_id long, chars long, n_bytes long, digest binary, body binary"
TEXT = "bucket int, n_bytes long, chars long, doc_id long, row long, n long, digest binary, body binary"


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bodies = [(t.as_py() or b"").translate(None, SPACE) for t in b.column(3).cast(pa.binary())]
        digests = [hashlib.sha256(x).digest() for x in bodies]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(map(len, bodies), pa.int64()), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["row", "doc_id", "chars", "n_bytes", "digest", "body"])
    shared.trim()


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.binary()]
    names = [x.split()[0] for x in TEXT.split(", ")]
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    for row in rows:
        held.append(row)
        size += len(row[-1] or b"") + 200
        if size >= 8 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def bucket(digest: bytes, n_bytes: int, buckets: int, salt: int = 0) -> int:
    """By length and content hash."""
    return (int.from_bytes(digest[:8], "little") + 0x9E3779B97F4A7C15 * n_bytes + 0xD1B54A32D192ED03 * salt & (1 << 64) - 1) % buckets


def _combine(buckets: int, hot: frozenset[bytes], salts: int):
    """Rows -> one row for each different text that a task has seen, or has seen since its trie was full."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % salts

        def out(trie: Trie) -> Iterator[tuple]:
            for body, x in trie.finish():
                yield bucket(x.digest, len(body), buckets, 1 + part if x.digest in hot else 0), len(body), x.chars, x.doc_id, x.row, x.n, x.digest, body

        def rows() -> Iterator[tuple]:
            trie = Trie()
            for b in batches:
                for body, *x in zip(*(b.column(c) for c in ("body", "digest", "chars", "doc_id", "row", "n"))):
                    trie.insert(body.as_py(), Best(*(v.as_py() for v in x)))
                    if trie.size > COMBINE_BYTES:
                        yield from out(trie)
                        trie = Trie()
            yield from out(trie)

        yield from _batches(rows())
        shared.trim()

    return combine


def _own(path: str, limit: int, hot: frozenset[bytes]):
    """The texts of a partition -> one row each; bodies are kept of hot ones, for the next round."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        trie, seen = Trie(limit, f"{path}/{task.partitionId()}-{task.taskAttemptId()}"), set()
        for b in batches:
            for body, *x in zip(*(b.column(c) for c in ("body", "digest", "chars", "doc_id", "row", "n"))):
                trie.insert(body.as_py(), Best(*(v.as_py() for v in x)))

        def rows() -> Iterator[tuple]:
            for body, x in trie.finish():
                if x.digest in seen:
                    raise ValueError("two texts with one digest")
                seen.add(x.digest)
                yield 0, len(body), x.chars, x.doc_id, x.row, x.n, x.digest, body if x.digest in hot else None

        yield from _batches(rows())
        shared.trim()

    return own


def _round(spark: SparkSession, texts: DataFrame, buckets: int, limit: int, hot: frozenset[bytes], salts: int) -> DataFrame:
    dealt = texts.mapInArrow(_combine(buckets, hot, salts), TEXT).repartitionById(buckets, "bucket")
    path = shared.new_path(spark, "trie-spill")
    kept = shared.write_table(spark, dealt.mapInArrow(_own(path, limit, hot), TEXT).drop("bucket"), "owners")
    shared.drop_path(spark, path)
    return kept


def owners(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """A row for each document: (doc_id, chars, keep_id: doc_id of the row that stays, group_size, kept, text_sha256)."""
    text = F.col(text_col).cast("string")
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("chars"), text.alias("text"))
    rows = shared.write_table(spark, plain.mapInArrow(_normalised, ROW), "normalised")

    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("size"))
    large = (F.col("n") > 1) & ((F.col("n") > n // HOT_PARTS) | (F.col("size") > size // HOT_PARTS))
    hot = frozenset(bytes(r[0]) for r in groups.where(large).select("digest").collect())  # fewer than 2 * HOT_PARTS

    buckets = max(shared.partitions(spark), -(-size // PART_BYTES))
    texts = rows.withColumn("n", F.lit(1).cast("long"))
    found = _round(spark, texts, buckets, trie_bytes, hot, SALTS)
    if hot:
        again = _round(spark, found.where("body IS NOT NULL"), shared.partitions(spark), trie_bytes, frozenset(), 1)
        found = found.where("body IS NULL").unionByName(again)
    best = found.select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    return rows.join(best, "digest").select("doc_id", "chars", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    stay = owners(spark, docs, id_col, text_col).where("kept").select(F.struct("doc_id", "chars").alias("at"), "text_sha256")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = F.translate(text, SPACE.decode(), "")
    # Columns of docs are in one struct, so that no name of theirs can clash.
    whole = docs.select(F.struct(F.col(id_col).cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("chars")).alias("at"), F.sha2(body, 256).alias("text_sha256"), F.struct("*").alias("doc"))
    same = whole["at"].eqNullSafe(stay["at"]) & (whole["text_sha256"] == stay["text_sha256"])
    return whole.join(stay, same, "left_semi").dropDuplicates(["text_sha256"]).select("doc.*")
