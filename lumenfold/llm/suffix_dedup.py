"""Suffix-array dedup: bytes of repeated strings are removed, their first occurrences stay.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier (in a document of
smaller id, or earlier in the same one). Matches never cross documents and are judged on the input.

Suffixes are brought together by content, so that each is sorted once and no pair of shards is compared
that can't match: every window of ``length`` bytes is keyed by the least hash of its 16-byte grams
(its minimizer), and runs of windows with one key travel as one fragment, packed, to the key's task. Equal
windows have equal keys, so all occurrences of a string meet. Copies of whole fragments are merged
before they are sent, and again where they arrive, and fragments that can share no window
are dropped there; keys
with very many fragments, as a common passage makes them, are told apart by window: what is left is cut into shards of bounded size. A suffix array of each shard is made by Larsson-Sadakane
refinement (only groups not yet sorted are refined, by ranks at doubled distance), common prefixes by
Kasai's theorem (only those that can't be derived from the one before are compared), and groups with a
common prefix of ``length`` bytes share a string. Where one key's fragments fill several shards, the
shards' sorted strings are merged by binary search.

Defined results: null is an empty text; rows that share an id (null ids share one, which is -2^62 and sorts first but for lower ones) count
as occurrences in one document at their places, so spans found in one of them apply to each; repeated
rows thus give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared

LENGTH = 100
GRAM = 16
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
#: Text whose fragments are packed together: the more, the fewer and larger the rows that a task sends.
HELD_BYTES = 32 << 20
#: Packed rows that are handed over at a time.
SENT_BYTES = 4 << 20
#: Bytes of text whose fragments go to one task.
BYTES_A_TASK = 16 << 20
#: Text of the sample that finds keys with very many fragments, and the least number that counts.
SAMPLE_BYTES = 16 << 20
HOT_LEAST = 64
LEAST = -(1 << 62)


# --- suffix arrays ---------------------------------------------------------------------------------


def suffix_array(text: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The order of all suffixes of text (uint8), where the suffix at i ends before stops[i].

    Suffixes of equal content are ordered by place. The first seven symbols (a byte + 1, or 0 past the
    end) sort the groups; each round then sorts what shares a group by the ranks h places on."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    left = stops - np.arange(n)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key << np.uint64(9) | np.where(left > j, padded[j : n + j], np.uint64(0))
    order = np.argsort(key, kind="stable")
    key = key[order]
    rank = np.empty(n, np.int64)
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(head, n))
    rank[order] = np.repeat(head, size)
    h = 7
    while True:
        # Groups of suffixes that have ended are equal strings, in order of place already.
        open_ = (size > 1) & (left[order[head]] >= h)
        done = (size > 1) & ~open_
        if done.any():
            slots = np.repeat(head[done], size[done]) + _within(size[done])
            rank[order[slots]] = slots
        if not open_.any():
            return order
        slots = np.repeat(head[open_], size[open_]) + _within(size[open_])
        at = order[slots]
        # 0 where the suffix ends here, which comes before all others.
        key = rank[at] << 32 | np.where(left[at] > h, rank[np.minimum(at + h, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        first = np.concatenate([[True], key[1:] != key[:-1]])
        head = slots[first]
        size = np.diff(np.append(np.flatnonzero(first), len(slots)))
        rank[at] = np.repeat(head, size)
        h *= 2


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def common_prefixes(text: np.ndarray, stops: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the suffix array, how many bytes it shares with the one before (0 for the first).

    Kasai's theorem: if suffix i and the one before it in the array are preceded by equal bytes, then i - 1
    has the one before as its neighbour too, and shares one byte more. So only the other suffixes are
    compared; the rest follow by place."""
    n = len(text)
    prior = np.full(n, -1)
    prior[order[1:]] = order[:-1]
    place = np.arange(n)
    start = np.concatenate([[True], stops[1:] != stops[:-1]]) if n else np.zeros(0, bool)  # of a fragment
    derived = (prior > 0) & ~start
    derived[derived] = ~start[prior[derived]] & (text[place[derived] - 1] == text[prior[derived] - 1])
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)).view(">u8").ravel()[:n].astype(np.uint64) if n else np.zeros(0, np.uint64)
    own = np.flatnonzero(~derived & (prior >= 0))
    most = np.minimum(stops[own] - own, stops[prior[own]] - prior[own])
    shared_bytes = np.zeros(len(own), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        a = own[active] + shared_bytes[active]
        b = prior[own[active]] + shared_bytes[active]
        differ = words[a] ^ words[b]
        same = np.where(differ == 0, 8, _leading_zero_bytes(differ))
        shared_bytes[active] += same
        over = shared_bytes[active] >= most[active]
        active = active[(same == 8) & ~over]
    shared_bytes = np.minimum(shared_bytes, most)
    value = np.full(n, -1, np.int64)
    value[own] = shared_bytes
    value[prior < 0] = 0
    last = np.maximum.accumulate(np.where(value >= 0, place, 0))
    by_place = value[last] - (place - last)
    return by_place[order]


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for shift in (56, 48, 40, 32, 24, 16, 8):
        out += x >> np.uint64(shift) == 0
    return out


# --- fragments ---------------------------------------------------------------------------------------


class Fragments:
    """Runs of windows: key, document, first window's place, number of windows, whether two of its
    windows may be equal, and where the bytes are."""

    def __init__(self, key, doc, start, count, inner, text: np.ndarray, at):
        self.key, self.doc, self.start, self.count, self.inner, self.text, self.at = key, doc, start, count, inner, text, at

    def __len__(self) -> int:
        return len(self.key)

    def take(self, rows: np.ndarray) -> Fragments:
        return Fragments(self.key[rows], self.doc[rows], self.start[rows], self.count[rows], self.inner[rows], self.text, self.at[rows])


def joined(parts: list[Fragments]) -> Fragments:
    """Fragments of one text, one list after another."""
    columns = [np.concatenate([getattr(p, c) for p in parts]) for c in ("key", "doc", "start", "count", "inner", "at")]
    return Fragments(*columns[:5], parts[0].text, columns[5])


def of_one_text(parts: list[Fragments]) -> Fragments:
    """Fragments of several texts, as fragments of these texts put together."""
    edges = np.cumsum([0, *(len(p.text) for p in parts)])
    moved = [Fragments(p.key, p.doc, p.start, p.count, p.inner, p.text, p.at + base) for p, base in zip(parts, edges)]
    moved[0].text = np.concatenate([p.text for p in parts])
    return joined(moved)


def _grams(text: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on (short at the end)."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(15, np.uint8)]), 8)).view("<u8").ravel()
    return blobs.mix(words[:-8] * np.uint64(0x9E3779B97F4A7C15) + words[8:])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def fragments(pieces: list[tuple[int, int, bytes]], length: int) -> tuple[Fragments, np.ndarray]:
    """Fragments of pieces (document, offset, bytes), in the order of the pieces, and a sum of the hashes
    of each one's grams."""
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    text = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    ends = np.cumsum(sizes)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.sum():
        empty = np.zeros(0, np.int64)
        return Fragments(empty.astype(np.uint64), empty, empty, empty, empty.astype(bool), text, empty), empty.astype(np.uint64)
    grams = _grams(text)
    least = _sliding_min(grams, length - GRAM + 1)
    piece = np.repeat(np.arange(len(pieces)), windows)
    place = np.repeat(ends - sizes, windows) + _within(windows)
    key = least[place]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])]))
    count = np.diff(np.append(first, len(key)))
    at, owner = place[first], piece[first]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams, dtype=np.uint64)])
    digest = total[at + count + length - GRAM] - total[at]
    doc = np.array([p[0] for p in pieces], np.int64)
    start = at - (ends - sizes)[owner] + np.array([p[1] for p in pieces], np.int64)[owner]
    # Equal windows have their first least gram at the same distance, so one fragment holds two of them
    # only if that gram is not at one place for all its windows.
    width, inner = length - GRAM + 1, np.zeros(len(at), bool)
    for i in range(0, len(at), 1 << 14):
        a, b = at[i : i + (1 << 14)], (at + count - 1)[i : i + (1 << 14)]
        inner[i : i + (1 << 14)] = a + grams[a[:, None] + np.arange(width)].argmin(axis=1) != b + grams[b[:, None] + np.arange(width)].argmin(axis=1)
    return Fragments(key[first], doc[owner], start, count, inner, text, at), digest


def digest_of(f: Fragments, length: int) -> np.ndarray:
    """The sum of the hashes of each fragment's grams, as fragments() gives it. The text is hashed about a
    MB at a time; fragments are in its order."""
    out, last = np.zeros(len(f), np.uint64), f.at + f.count + length - 1
    edges = np.flatnonzero(np.diff(f.at >> 20, prepend=-1))
    for i, j in zip(edges, np.append(edges[1:], len(f))):
        base = f.at[i]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_grams(f.text[base : last[i:j].max()]), dtype=np.uint64)])
        out[i:j] = total[last[i:j] - GRAM + 1 - base] - total[f.at[i:j] - base]
    return out


def merge_copies(f: Fragments, digest: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragments to keep, fragments that are copies of an earlier one): equal in all bytes, first by
    document and place. Copies at the place of the one kept are in neither."""
    if not len(f):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = blobs.mix(f.key + blobs.mix(digest + f.count.astype(np.uint64)))
    order = np.lexsort((f.start, f.doc, label))
    new = np.concatenate([[True], label[order][1:] != label[order][:-1]])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    rest = np.flatnonzero(~new)
    member, first = order[rest], head[rest]
    equal = np.zeros(len(member), bool)
    step = max(1, (1 << 20) // (int(f.count.max()) + length)) if len(member) else 1
    for i in range(0, len(member), step):
        m, k = member[i : i + step], first[i : i + step]
        alike = (f.count[m] == f.count[k]) & (f.key[m] == f.key[k])
        size = np.where(alike, f.count[m] + length - 1, 1)
        on = _within(size)
        same = f.text[np.repeat(f.at[m], size) + on] == f.text[np.repeat(f.at[k], size) + on]
        equal[i : i + step] = alike & np.logical_and.reduceat(same, np.cumsum(size) - size)
    here = equal & (f.doc[member] == f.doc[first]) & (f.start[member] == f.start[first])
    return np.sort(np.concatenate([order[new], member[~equal]])), member[equal & ~here]


def repeated(x: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, inverse, counts = np.unique(x, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def shards(f: Fragments, length: int, most: int) -> Iterator[list[np.ndarray]]:
    """Lists of shards, each a set of fragments of bounded size; a list of more than one has one key."""
    order = np.lexsort((f.start, f.doc, f.key))
    size = np.cumsum(f.count[order] + length - 1)
    ends = np.append(np.flatnonzero(f.key[order][1:] != f.key[order][:-1]) + 1, len(order))
    begin, last = 0, 0
    for end in ends.tolist():
        used = size[end - 1] - (size[begin - 1] if begin else 0)
        if used > most and last > begin:
            yield [order[begin:last]]
            begin = last
            used = size[end - 1] - size[begin - 1]
        if used > most:
            parts = (size[begin:end] - (size[begin - 1] if begin else 0) - 1) // most
            yield [order[begin:end][parts == i] for i in np.unique(parts)]
            begin = end
        last = end
    if begin < len(order):
        yield [order[begin:]]


class Shard:
    """The suffix array of some fragments, cut into groups of equal windows."""

    def __init__(self, f: Fragments, length: int):
        size = f.count + length - 1
        within = _within(size)
        self.text = f.text[np.repeat(f.at, size) + within]
        stops = np.repeat(np.cumsum(size), size)
        order = suffix_array(self.text, stops)
        prefix = common_prefixes(self.text, stops, order)
        owner = np.repeat(np.arange(len(f)), size)
        fits = within[order] < f.count[owner[order]]
        group = np.cumsum(prefix < length)[fits]
        at = order[fits]
        self.at, self.doc, self.place = at, f.doc[owner[at]], (f.start[owner] + within)[at]
        by = np.lexsort((self.place, self.doc, group))
        self.at, self.doc, self.place, group = self.at[by], self.doc[by], self.place[by], group[by]
        self.first = np.concatenate([[True], group[1:] != group[:-1]])
        head = np.maximum.accumulate(np.where(self.first, np.arange(len(by)), 0))
        self.gone = (self.doc != self.doc[head]) | (self.place != self.place[head])

    def strings(self, length: int) -> np.ndarray:
        """The distinct windows, sorted: as groups are in the order of the suffix array."""
        return np.ascontiguousarray(self.text[self.at[self.first][:, None] + np.arange(length)]).view(f"S{length}").ravel()


def merge_shards(parts: list[Shard], length: int) -> None:
    """Mark the windows that other shards of the list hold earlier, by binary search among their sorted strings."""
    firsts = [np.flatnonzero(p.first) for p in parts]
    for j in range(1, len(parts)):
        mine = parts[j].strings(length)
        for i in range(j):
            other = parts[i].strings(length)
            spot = np.minimum(np.searchsorted(other, mine), len(other) - 1)
            hit = np.flatnonzero(other[spot] == mine)
            a, b = firsts[i][spot[hit]], firsts[j][hit]
            here, there = (parts[j].doc[b], parts[j].place[b]), (parts[i].doc[a], parts[i].place[a])
            later = (here[0] > there[0]) | ((here[0] == there[0]) & (here[1] > there[1]))
            sooner = (here[0] < there[0]) | ((here[0] == there[0]) & (here[1] < there[1]))
            parts[j].gone[b[later]] = True
            parts[i].gone[a[sooner]] = True


def removed_windows(f: Fragments, length: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, places) of windows in distinct fragments that occur earlier."""
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for parts in shards(f, length, shard_bytes):
        made = [Shard(f.take(rows), length) for rows in parts]
        merge_shards(made, length)
        for s in made:
            docs.append(s.doc[s.gone])
            places.append(s.place[s.gone])
    return np.concatenate(docs), np.concatenate(places)


def to_spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents, sorted, with those that touch or overlap made one."""
    if not len(doc):
        return doc, start, stop
    by = np.lexsort((start, doc))
    doc, start, stop = doc[by], start[by], stop[by]
    # Stops rise within a document once a document's number is put before them.
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    base = int(stop.max()) + 1
    reach = np.maximum.accumulate(number * base + stop) - number * base
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(doc) - 1)
    return doc[first], start[first], reach[last]


# --- tasks ---------------------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    held, size = [], 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            data = text.as_py() or b""
            for at in range(0, max(1, len(data) - length + 1), BLOCK_BYTES):
                held.append((doc_id, at, data[at : at + BLOCK_BYTES + length - 1]))
                size += len(held[-1][2])
                if size >= BLOCK_BYTES:
                    yield sorted(held, key=lambda p: p[:2])
                    held, size = [], 0
    if held:
        yield sorted(held, key=lambda p: p[:2])


def _sampled_keys(length: int):
    """Keys of fragments with their numbers."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _pieces(batches, length):
            key, n = np.unique(fragments(pieces, length)[0].key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)[n > 1]), pa.array(n[n > 1])], ["key", "n"])

    return sample


def hot_keys(docs: DataFrame, length: int, size: int, buckets: int) -> np.ndarray:
    """Keys that would fill more than a quarter of a task, by a sample of documents; at most four for each
    task. This only plans where fragments go: results are the same for any list."""
    share = max(1, size // SAMPLE_BYTES)
    least = max(HOT_LEAST, size // share // 45 // (4 * buckets))
    sampled = docs.where(F.pmod(F.xxhash64("k"), F.lit(share)) == 0).select("k", "text").mapInArrow(_sampled_keys(length), "key long, n long")
    rows = sampled.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(4 * buckets).collect()
    return np.sort(np.array([r["key"] for r in rows], np.int64).view(np.uint64))


def by_far_end(f: Fragments, grams: np.ndarray, length: int) -> Fragments:
    """Each window as a fragment of its own, keyed also by its 16 bytes farthest from the least gram.

    Windows of a common passage that reach into what stands around it differ at that end, so they are
    spread over many keys; those within the passage are alike, and merged."""
    owner, on = np.repeat(np.arange(len(f)), f.count), _within(f.count)
    at, width = f.at[owner] + on, length - GRAM + 1
    near = np.concatenate([np.zeros(0, np.int64), *(grams[at[i : i + (1 << 14), None] + np.arange(width)].argmin(axis=1) for i in range(0, len(at), 1 << 14))])
    first = near * 2 >= width
    far = np.where(first, at, at + length - GRAM)
    ends = grams[far] + first.astype(np.uint64)
    return Fragments(blobs.mix(f.key[owner] + blobs.mix(ends)), f.doc[owner], f.start[owner] + on, np.ones(len(at), np.int64), np.zeros(len(at), bool), f.text, at)


def _planes(x: np.ndarray) -> np.ndarray:
    """The first bytes of all values, then the second ones, and so on: high bytes are alike and compress away."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T)


def _from_planes(flat: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(held: list[Fragments], spans: list[tuple[np.ndarray, ...]], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """What is held, cut by bucket: one row for the spans of a bucket's documents, one for its fragments."""
    rows, size = [], 0

    def made() -> Iterator[tuple[int, bytes]]:
        doc, start, stop = to_spans(*(np.concatenate([s[i] for s in spans]) for i in range(3)))
        for i, columns in blobs.cut((blobs.mix(doc) % np.uint64(buckets)).astype(np.int32), doc, start, stop):
            yield i, blobs.pack(*columns)
        f = of_one_text(held)
        data = memoryview(f.text)
        for i, (key, doc, start, count, inner, at) in blobs.cut((blobs.mix(f.key) % np.uint64(buckets)).astype(np.int32), f.key, f.doc, f.start, f.count, f.inner, f.at):
            text = b"".join([data[a:b] for a, b in zip(at.tolist(), (at + count + length - 1).tolist())])
            # Within a task 32 bits tell keys apart well enough: keys that collide are compared for nothing.
            key = (blobs.mix(key) >> np.uint64(32)).astype(np.uint32)
            yield i, blobs.pack(_planes(key), _planes(np.diff(doc, prepend=np.int64(0))), _planes(start), _planes(count), inner, text, level=6)

    for row in made():
        rows.append(row)
        size += len(row[1])
        if size >= SENT_BYTES:
            yield blobs.batch(rows)
            rows, size = [], 0
    yield blobs.batch(rows)


def _scatter(length: int, buckets: int, hot: np.ndarray):
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, spans, size = [], [], 0
        for pieces in _pieces(batches, length):
            f, digest = fragments(pieces, length)
            keep, copies = merge_copies(f, digest, length)
            gone, kept = [f.take(copies)], f.take(keep)
            is_hot = np.isin(kept.key, hot)
            if is_hot.any():
                single = by_far_end(kept.take(np.flatnonzero(is_hot)), _grams(f.text), length)
                few, again = merge_copies(single, digest_of(single, length), length)
                gone.append(single.take(again))
                kept = joined([kept.take(np.flatnonzero(~is_hot)), single.take(few)])
            gone = joined(gone)
            spans.append(to_spans(gone.doc, gone.start, gone.start + gone.count + length - 1))
            held.append(kept)
            size += len(kept.text)
            del f, digest, keep, copies, gone, kept
            if size >= HELD_BYTES:
                yield from _packed(held, spans, length, buckets)
                held, spans, size = [], [], 0
        if held:
            yield from _packed(held, spans, length, buckets)
        shared.trim()

    return scatter


def _gather(length: int, shard_bytes: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, parts, packed = [], [], []
        for b in batches:
            for x in b.column(1):
                columns = blobs.unpack(x.as_py())
                if len(columns) == 3:
                    spans.append(columns)
                else:
                    key, doc, start, count = (_from_planes(c, kind) for c, kind in zip(columns, (np.uint32, np.int64, np.int64, np.int64)))
                    parts.append([key, np.cumsum(doc), start, count, columns[4].copy()])
                    packed.append(x.as_py())
                del columns
        found = [tuple(s) for s in spans]
        if parts:
            key, doc, start, count, inner = (np.concatenate([p[i] for p in parts]) for i in range(5))
            edges = np.cumsum([0, *(len(p[0]) for p in parts)])
            del parts
            # Only fragments whose key comes twice can share a window: of the others no bytes are kept. The
            # blobs stay packed meanwhile, and are opened again one by one.
            twice = repeated(key) | inner
            size, text = count + length - 1, []
            for x, a, b in zip(packed, edges, edges[1:]):
                if twice[a:b].any():
                    text.append(np.frombuffer(blobs.unpack(x)[5], np.uint8)[np.repeat(twice[a:b], size[a:b])])
            del packed
            size = size[twice]
            f = Fragments(key[twice].astype(np.uint64), doc[twice], start[twice], count[twice], inner[twice], np.concatenate(text) if text else np.zeros(0, np.uint8), np.cumsum(size) - size)
            del text, key, doc, start, count
            keep, copies = merge_copies(f, digest_of(f, length), length)
            found.append((f.doc[copies], f.start[copies], f.start[copies] + f.count[copies] + length - 1))
            kept = f.take(keep)
            kept = kept.take(np.flatnonzero(repeated(kept.key) | kept.inner))
            if len(kept):
                doc, place = removed_windows(kept, length, shard_bytes)
                found.append((doc, place, place + length))
        if found:
            doc, start, stop = to_spans(*(np.concatenate([x[i] for x in found]) for i in range(3)))
            head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
            edges = np.append(head, len(doc)) * 2
            flat = np.stack([start, stop], axis=1).ravel()
            for i in range(0, len(head), 20_000):
                part = edges[i : i + 20_001]
                lists = pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(flat[part[0] : part[-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(doc[head[i : i + 20_000]]), lists], ["k", "spans"])
        shared.trim()

    return gather


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc_id, text, lists in zip(b.column(0), b.column(1).cast(pa.binary()), b.column(2)):
            data = text.as_py() or b""
            flat = np.array([x for one in lists.as_py() or [] for x in one], np.int64).reshape(-1, 2)
            _, start, stop = to_spans(np.zeros(len(flat), np.int64), flat[:, 0], np.minimum(flat[:, 1], len(data)))
            fits = start < stop
            start, stop = start[fits].tolist(), stop[fits].tolist()
            kept = b"".join(data[i:j] for i, j in zip([0, *stop], [*start, len(data)]))
            out.append((doc_id.as_py(), len(data), len(data) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), [x for s in zip(start, stop) for x in s]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(k, lists): for each document key with repeats, lists of span borders, unmerged between tasks. docs: (k, text)."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(shared.partitions(spark), -(-size // BYTES_A_TASK))
    hot = hot_keys(docs, length, size, buckets)
    dealt = blobs.deal(docs.select("k", "text").mapInArrow(_scatter(length, buckets, hot), blobs.SCHEMA), buckets)
    return dealt.mapInArrow(_gather(length, shard_bytes), "k long, spans array<bigint>").groupBy("k").agg(F.collect_list("spans").alias("lists"))


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: borders of the removed runs, in bytes)."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes can be searched")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("k"))
    joined = rows.join(repeated_spans(spark, rows, length, shard_bytes), "k", "left").select("doc_id", "text", "lists")
    return joined.mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<bigint>")
