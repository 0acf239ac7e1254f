"""Runs of words that repeat with a period, found by block matching.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that holds
at least ``min_periods`` periods and ``min_words`` words and that no neighbouring word extends.

For each power of two B, the document's aligned blocks of B words are the keys of an Aho-Corasick
automaton, and the document is searched with it. Keys are sequences of word numbers, or of the numbers of
B/8-word grams for larger blocks: an automaton walks all suffixes of what it has matched, which for a
block of one repeated word are as many as the key is long. An occurrence of a block at a distance q with
B <= q < 2B is a seed: word pairs q apart are compared in both directions until they differ. A run of a
period q in that range has three periods or more, so it holds a whole aligned block and its occurrence q
words on: no run is missed. The window of distances is B wide, so one occurrence meets one block only,
and a scale has no more seeds than words.

Before a scale's automaton is built, stretches that can't hold a run of that scale are left out: each word
of a run is part of a gram (up to four words) that recurs less than 2B words away. Grams are compared
by hash there; a collision keeps a stretch in, and the comparison of words decides.

Documents are handled one by one where they are read, without a shuffle; memory follows the longest text
(some 100 bytes a word). Defined results: null, empty and blank texts have no words and no runs; a null
doc_id is kept; repeated rows give repeated rows; an empty table gives an empty one; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared

MIN_WORDS, MIN_PERIODS = 6, 4
#: Bytes of collapsed text that are handed over at once.
BATCH_BYTES = 8 << 20
#: A gram of the filter has so many words at most, a key so many numbers.
GRAM, KEY = 4, 8

Run = tuple[int, int, int]


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 1 on."""
    known: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _gaps(ids: np.ndarray, k: int) -> np.ndarray:
    """For each gram of k words the distance to the nearest gram of the same hash; the length where there is none."""
    n = len(ids) - k + 1
    h = ids[:n].astype(np.uint64)
    for i in range(1, k):
        h = blobs.mix(h) + ids[i : n + i].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    apart = np.where(h[order[1:]] == h[order[:-1]], np.diff(order), len(ids))
    out = np.empty(n, np.int64)
    out[order] = np.minimum(np.append(apart, len(ids)), np.insert(apart, 0, len(ids)))
    return out


def _stretches(alive: np.ndarray, least: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(alive.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def _pairs(names: np.ndarray, size: int) -> np.ndarray:
    """Numbers of grams -> numbers of grams of twice the size; equal grams have equal numbers, from 1 on."""
    if len(names) <= size:
        return np.zeros(0, np.int64)
    both = names[:-size] * (int(names.max()) + 1) + names[size:]
    return np.unique(both, return_inverse=True)[1].astype(np.int64) + 1


def _seeds(names: np.ndarray, size: int, stretches: list[tuple[int, int]], block: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of a block, distance to an occurrence) for distances from block to twice the block.

    names: numbers of the grams of so many words at each position. The stretches are laid out one after
    another, a zero after each; blocks are aligned in that layout."""
    origin = np.concatenate([np.arange(s, e + 1) for s, e in stretches])
    stretch = np.repeat(np.arange(len(stretches)), [e - s + 1 for s, e in stretches])
    ends = np.repeat([e for _, e in stretches], [e - s + 1 for s, e in stretches])
    inside = origin + size <= ends
    laid = np.zeros(-(-len(origin) // size) * size, np.int64)
    laid[: len(origin)][inside] = names[origin[inside]]
    tree = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    keys: dict[tuple[int, ...], int] = {}
    blocks = len(laid) // block
    key_of = np.full(blocks + 1, -1, np.int64)
    for i, key in enumerate(map(tuple, laid[: blocks * block].reshape(blocks, -1)[:, ::size].tolist())):
        if 0 not in key:
            key_of[i] = n = keys.setdefault(key, len(keys))
            if n == len(keys) - 1:
                tree.add_word(key, n)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree.make_automaton()
    # A key has every size-th position, so the text is searched once for each remainder, a zero after each.
    searched = np.pad(laid.reshape(-1, size).T, ((0, 0), (0, 1)))
    hits = np.fromiter(tree.iter(tuple(searched.ravel().tolist())), np.dtype((np.int64, 2)))
    row, column = np.divmod(hits[:, 0], searched.shape[1])
    found, key = (column + 1) * size - block + row, hits[:, 1]
    owner = found // block - 1  # the only aligned block at a distance from block to 2 * block - 1
    seen = (owner >= 0) & (key_of[owner] == key)
    found, owner = found[seen], owner[seen] * block
    seen = stretch[found] == stretch[owner]
    starts, apart = origin[owner[seen]], (found - owner)[seen]
    order = np.lexsort((apart, starts))
    return starts[order], apart[order]


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return n


def _repeats(root: np.ndarray) -> bool:
    """Whether the root is a shorter sequence repeated."""
    q = rest = len(root)
    f = 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            if (root[q // f :] == root[: q - q // f]).all():
                return True
            while rest % f == 0:
                rest //= f
        f += 1
    return False


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """All runs as (start, length, period), by start, then period."""
    if min_periods < 3:
        raise ValueError("a run must hold three periods at least, else an aligned block may be missed")
    runs: list[Run] = []
    gaps: dict[int, np.ndarray] = {}
    names, size, block = ids, 1, 1
    while max(min_words, min_periods * block) <= len(ids):
        k = min(block, GRAM)
        if k not in gaps:
            gaps = {k: _gaps(ids, k)}
        least = max(min_words, min_periods * block)
        stretches = [(s, e + k - 1) for s, e in _stretches(gaps[k] < 2 * block, least - k + 1)]
        if stretches:
            while size * KEY < block:
                names, size = _pairs(names, size), 2 * size
            starts, apart = _seeds(names, size, stretches, block)
            keep = np.ones(len(starts), bool)
            for s, length, q in runs:  # what a run of period q repeats at multiples of q is no run of its own
                if length >= 2 * block:
                    a, b = np.searchsorted(starts, [s, s + length])
                    keep[a:b] &= (apart[a:b] % q != 0) | (starts[a:b] + apart[a:b] + block > s + length)
            tried: dict[int, int] = {}  # by distance: where the last comparison ended
            for b, q in zip(starts[keep].tolist(), apart[keep].tolist()):
                if b < tried.get(q, 0):
                    continue
                right = b + block + _same(ids[b + block :], ids[b + block + q :])
                left = b - _same(ids[:b][::-1], ids[q : b + q][::-1])
                tried[q] = right
                length = right - left + q
                if length >= max(min_words, min_periods * q) and not _repeats(ids[left : left + q]):
                    runs.append((left, length, q))
        block *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """False for each word that stands in a run after the run's first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:n] == 0


def with_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs: array of (start, length, period), collapsed: the text's words with one period
    left of each run, joined by single spaces)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            ids, ns, runs, texts = zip(*rows)
            runs = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                runs = find_runs(numbers(words), min_words, min_periods) if len(words) >= min_words else []
                if runs:
                    keep = kept_words(len(words), runs).tolist()
                    words = [w for w, k in zip(words, keep) if k]
                rows.append((doc_id, len(words) if not runs else len(keep), runs, b" ".join(words)))
                size += len(rows[-1][3]) + 100
                if size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()
        shared.trim()

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(search, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
