"""Token-ID / binary output.

Format of one part: ``part-NNNNNN.bin`` holds the ids of its documents, one after another, as flat
little-endian unsigned integers (16 bits where the vocabulary allows, else 32). ``part-NNNNNN.idx``
holds 64-bit integers: the number of documents, how many of them have a null id (they come first),
the document ids (null: 0), and n + 1 offsets into the part, in ids. ``manifest.json`` lists the parts
in order with their bases: the number of ids in all parts before, by prefix sums over the parts.

Defined results: a null text is an empty one and so has the end id only; null ids sort first; rows
that share a doc_id are all written, in the order of their texts; an empty table gives no parts and
no rows; columns other than the id and text are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import shared

#: Fixed: the pre-token pattern of the byte-level vocabulary, with Unicode's white space spelled out.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: A bound on a worker's cache of encoded words. It has two halves: a full one becomes the old one, and
#: what is met again moves out of that, so the words in use stay.
CACHE_BYTES = 192 << 20
#: What an entry takes beside its characters and ids.
ENTRY_BYTES = 200
BATCH_CHARS = 4 << 20
#: Text of a part, about, and what a row counts for beside it: parts grow in number, not in size.
PART_BYTES, ROW_BYTES = 256 << 20, 64
#: Leading characters by which rows of one place in the order may be parted.
HEAD_CHARS = 64
#: Words that are encoded as one text.
WORDS_A_TEXT = 20_000
STOPS = ".,:;!?"
_STOPPED = f"^\\n?\\p{{L}}+[{STOPS}]$"


_other_space = re.compile(r"[^\S\n ]").search
_edges = (" ", "\n")


def single_spaced(text: str) -> bool:
    """Whether the text is words with one space or line feed between each two, and no other white space."""
    return bool(text) and not (text.startswith(_edges) or text.endswith(_edges) or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _other_space(text))


class Encoder:
    """Ids of whole texts as bytes of dtype.

    BPE never merges across pre-tokens, so the tokenizer encodes each distinct pre-token once and its ids
    are reused. In a text whose words are parted by single spaces or line feeds, every word with what
    stands before it is a row of whole pre-tokens, so such texts are looked up by words; others are cut by
    the pattern."""

    def __init__(self, path: str, end_id: int | None, cache_bytes: int = CACHE_BYTES):
        import regex
        from tokenizers import Tokenizer

        self.cache_bytes = cache_bytes
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in spec["added_tokens"]]
        pre = spec.get("pre_tokenizer") or {}
        # Only this setting is known to split as PRE_TOKEN does; any other is encoded whole.
        self.split = regex.compile(PRE_TOKEN).findall if not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["model"].get("ignore_merges") else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        #: Which ids start with a space (the vocabulary writes its byte so).
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.spaced[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token[0] == "\u0120"]] = True
        self.bare: dict[str, bytes] = {}  # the ids of a string
        self.words: dict[str, bytes] = {}  # the ids of a space and a string; of the string alone if it starts with a line feed, or after a carriage return
        self.old_bare: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.size = 0

    def _bytes(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.dtype.itemsize == 2 else "I"
        if sys.byteorder == "little":
            return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced_bytes(self, words: list[str]) -> list[bytes]:
        """The ids of each word, which holds no white space, with a space before it.

        Many are encoded as one text: a single space always starts a pre-token, and so a token, and no other
        token of such a text starts with one."""
        out, width = [], self.dtype.itemsize
        for i in range(0, len(words), WORDS_A_TEXT):
            some = words[i : i + WORDS_A_TEXT]
            text = " " + " ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            edges = (np.append(np.flatnonzero(self.spaced[ids]), len(ids)) * width).tolist()
            if len(edges) != len(some) + 1 or any(a in text for a in self.added):
                out += self._bytes([" " + w for w in some])
            else:
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip(edges, edges[1:])]
        return out

    def _add(self, cache: dict[str, bytes], keys: list[str], ids: list[bytes]) -> None:
        cache.update(zip(keys, ids))
        self.size += sum(map(len, keys)) + sum(map(len, ids)) + ENTRY_BYTES * len(keys)

    def _unknown(self, cache: dict[str, bytes], old: dict[str, bytes], keys: Iterable[str]) -> list[str]:
        """The keys that neither half of a cache holds; those of the old half move to the new one."""
        missing, found = [], []
        for k in keys:
            if k not in cache:
                (found if k in old else missing).append(k)
        if found:
            self._add(cache, found, [old.pop(k) for k in found])
        return missing

    def _pieces(self, pieces: list[str]) -> bytes:
        """The ids of pre-tokens."""
        if new := self._unknown(self.bare, self.old_bare, set(pieces)):
            self._add(self.bare, new, self._bytes(new))
        return b"".join(map(self.bare.__getitem__, pieces))

    def _learn(self, words: list[str]) -> None:
        pieces = {w: self.split(w[1:] if w[0] == "\r" else w if w[0] == "\n" else " " + w) for w in words if not w.isalpha()}
        # One pre-token each, with its space: words of letters, and what other words start with.
        plain = self._unknown(self.words, self.old_words, {w for w in words if w.isalpha()} | {p[0][1:] for p in pieces.values() if p[0][0] == " "})
        self._add(self.words, plain, self._spaced_bytes(plain))
        self._pieces([p for w in pieces.values() for p in w if p[0] != " "])  # all at once, for what follows
        ids = [self.words[head[1:]] + self._pieces(rest) if head[0] == " " else self._pieces([head, *rest]) for head, *rest in pieces.values()]
        self._add(self.words, list(pieces), ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with the end id."""
        out, plain = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if not self.split or any(a in text for a in self.added):
                out[i] = self._bytes([text])[0] + self.end
            elif single_spaced(text):
                plain.append(i)
            else:
                out[i] = self._pieces(self.split(text)) + self.end
        if plain:
            self._by_words([texts[i] for i in plain], plain, out)
        if self.size > self.cache_bytes // 2:
            self.old_bare, self.old_words, self.bare, self.words, self.size = self.bare, self.words, {}, {}, 0
        return out

    def _by_words(self, texts: list[str], places: list[int], out: list[bytes]) -> None:
        """Each distinct word of the texts is looked up once; the ids of all are then gathered as arrays.

        A word after a line feed keeps it as its first character, and a text's first word gets a carriage
        return, which no such text has, to tell that no space stands before it."""
        marked = ["\r" + t.replace("\n", " \n") for t in texts]
        coded = pc.split_pattern(pa.array([" ".join(marked)], pa.large_string()), " ").flatten().dictionary_encode()
        # One string, cut again: quicker than a string for each value.
        words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        # A stop after letters is a pre-token of its own, so the word is looked up without it.
        stops, after = {c: self._pieces([c]) for c in STOPS}, [b""] * len(words)
        for i in np.flatnonzero(pc.match_substring_regex(coded.dictionary, _STOPPED).to_numpy(zero_copy_only=False)).tolist():
            words[i], after[i] = words[i][:-1], stops[words[i][-1]]
        ids = list(map(self.words.get, words))
        if None in ids:
            self._learn(self._unknown(self.words, self.old_words, dict.fromkeys(w for w, x in zip(words, ids) if x is None)))
            ids = list(map(self.words.__getitem__, words))
        ids = list(map(add, ids, after))
        # 32 bits suffice: a batch is some MB of text, or one text, which is less than 2^31 characters.
        edges = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(np.fromiter(map(len, ids), np.int32, len(ids)) // self.dtype.itemsize, out=edges[1:])
        taken = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.frombuffer(b"".join(ids), self.dtype))).take(coded.indices)
        tokens, stop = taken.values.to_numpy(), taken.offsets.to_numpy()[1:]
        ends = stop[np.cumsum([m.count(" ") + 1 for m in marked]) - 1]
        for place, a, b in zip(places, [0, *ends.tolist()], ends.tolist()):
            out[place] = tokens[a:b].tobytes() + self.end


@lru_cache(2)
def _encoder(path: str, end_id: int | None, cache_bytes: int) -> Encoder:
    """One for each worker process: tasks that follow find the tokenizer loaded and the cache filled."""
    return Encoder(path, end_id, cache_bytes)


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, some MB at a time."""
    group, chars = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        chars += len(group[-1])
        if chars >= BATCH_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _writer(path: str, tokenizer: str, end_id: int | None, cache_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, lengths, nulls = [], [], 0
        name = f"{path}/part-{part:06d}"
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = _encoder(tokenizer, end_id, cache_bytes)
        with shared.publish(f"{name}.bin") as f:
            for batch in chain([first], batches):
                for group in _groups(batch.column(1)):
                    for data in encoder.encode(group):
                        f.write(data)
                        lengths.append(len(data) // encoder.dtype.itemsize)
                nulls += batch.column(0).null_count
                ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        with shared.publish(f"{name}.idx") as f:
            f.write(np.concatenate([[len(lengths), nulls], *ids, offsets]).astype("<i8").tobytes())
        shared.trim()
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([len(lengths)]), pa.array([int(offsets[-1])]), pa.array([encoder.dtype.str])], ["part", "n_docs", "n_tokens", "dtype"])

    return write


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, order: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, cache_bytes: int = CACHE_BYTES) -> list[dict]:
    """Write docs, in the order of the named columns (default: the id), and return the manifest's parts.

    One range shuffle of the texts; the driver sees one row for each part. Parts are as many as the session's
    shuffle partitions, or more, so that one has about PART_BYTES of text. Rows of one place in the order are
    parted by their ids and the starts of their texts, so that a repeated id is not one part. cache_bytes: of encoded words that
    a worker keeps; fewer cost time, never results."""
    order = order or [id_col]
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    keys = [f"_order{i}" for i in range(len(order))]
    if parts is None:
        size = keyed.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES).cast("long")).alias("n")).first()["n"]
        parts = max(shared.partitions(spark), -(-(size or 0) // PART_BYTES))
    sorted_docs = keyed.repartitionByRange(parts, *keys, "doc_id", F.substring("text", 1, HEAD_CHARS)).sortWithinPartitions(*keys, "doc_id", "text")
    rows = sorted_docs.select("doc_id", "text").mapInArrow(_writer(path, tokenizer, end_id, cache_bytes), "part long, n_docs long, n_tokens long, dtype string").collect()
    listed, base = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        listed.append({"part": r["part"], "n_docs": r["n_docs"], "n_tokens": r["n_tokens"], "dtype": r["dtype"], "base": base})
        base += r["n_tokens"]
    with shared.publish(f"{path}/manifest.json") as f:
        f.write(json.dumps({"end_id": end_id, "n_tokens": base, "parts": listed}).encode())
    return listed


def open_part(path: str, part: int, dtype: str):
    """(document ids with None for null, offsets, ids) of a part, the last two memory-mapped."""
    index = shared.map_file(f"{path}/part-{part:06d}.idx", "<i8")
    n, nulls = int(index[0]), int(index[1])
    doc_ids = pa.array(index[2 : 2 + n], mask=np.arange(n) < nulls)
    return doc_ids, index[2 + n :], shared.map_file(f"{path}/part-{part:06d}.bin", dtype)


def _reader(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, offsets, ids = open_part(path, row["part"], row["dtype"])
                for lo in range(0, len(doc_ids), 4096):
                    hi = min(lo + 4096, len(doc_ids))
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]
                    at = np.asarray(offsets[lo : hi + 1])
                    yield pa.RecordBatch.from_arrays([doc_ids[lo:hi], pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
        shared.trim()

    return read


def read_token_files(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    """One row for each document of the files: doc_id, start, n_tokens, ids_crc32."""
    rows = [(p["part"], p["dtype"], p["base"]) for p in parts]
    listed = spark.createDataFrame(rows, "part long, dtype string, base long")
    return listed.repartition(max(1, len(rows))).mapInArrow(_reader(path), "doc_id long, start long, n_tokens long, ids_crc32 long")
