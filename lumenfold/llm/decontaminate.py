"""Benchmark decontamination: a BM25 inverted index of the test items, searched with block-max WAND.

Items are short, the corpus is not: the items are indexed and the corpus is the stream of queries. Each
document is cut into passages of twice the longest item's words, each starting that many words after the
one before, so that an item's words always lie within one passage. Every item is found whose BM25 score is
at least ``least_score`` of the score the item gives itself. A pair counts if at least ``least_overlap`` of
the item's word pairs are in the passage, and at least half of its question's word pairs (the question is
all but the last quarter of its words) and two fifths of its answer's words (the rest); items too short for
two such parts are one.

WAND looks into an item only if the bounds of those of its words that may be in the query reach the
threshold together. Here a posting's bound is what the item's words from this one on give, the weightiest
first: no item scores more than the bound of its weightiest word in the passage. So an item in reach has a
posting with a bound in reach among the passage's lists, its pivot, and pivots are all that is scored.
Postings are by item and in blocks with their best bound; of a list, blocks that fall short are jumped
over. Common words' bounds are small, so their long lists are jumped over nearly whole. The pivots of a step
of passages are taken at once, as arrays; nothing is as large as passages times items or blocks.

The index is broadcast, so its size is bounded: above ``INDEX_BYTES`` of item text it is cut into shards,
which are searched one after another. Numbers of items, document frequencies, mean and greatest lengths are
taken over all items first, so the shards change where weights are kept, and no score.

Defined results: words are runs of letters and digits (Unicode), lower-cased; null and wordless texts and
items match nothing; items with equal texts or ids are separate items, items equal in both count once; a
document row gives one row for each matching item id, and rows with equal doc_ids give equal or merged
rows; long texts are read some MB at a time; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import shared

#: Words of a shingle of the verification: pairs, as one changed word costs an item of 15 words two pairs
#: of 14, but five of 11 runs of five words.
WORDS = 2
LEAST_SCORE = 0.5
LEAST_OVERLAP = 0.6
LEAST_QUESTION, LEAST_ANSWER = 0.5, 0.4
#: The answer has a quarter of an item's words, and so many at least.
ANSWER_WORDS = 5
INDEX_BYTES = 32 << 20
#: Postings of a block.
BLOCK = 8
#: Passages of a step, and postings, or items' words, that are looked up at once, unless one passage has more.
STEP, CELLS = 256, 1 << 18
#: Words that a pivot's bound is lowered by, one by one, before its item is scored.
ROUNDS = 6
#: Characters of a long text that are cut into words at once, and of short texts that are searched together.
CHUNK_CHARS, GROUP_CHARS = 1 << 20, 1 << 18
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"

_words = re.compile(r"\w+")
_word = _words.findall
#: Sums of weights are taken in different orders; bounds are single numbers of 32 bits.
EPS, SLACK = 1e-9, 1e-5


def words_of(text: str | None) -> list[str]:
    return _word((text or "").lower())


def shingles(words: list[str], k: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def _expand(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges [start, stop), one after another, and the ranges' sizes."""
    size = stop - start
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum()), size


class Stats:
    """What the weights need to know of all items: their number, the terms' frequencies (by term, or in the order of the index), mean and greatest length."""

    def __init__(self, n: int, df, words: int, longest: int):
        self.n, self.df, self.mean, self.longest = n, df, words / max(1, n), longest


def _edges(sizes: np.ndarray) -> np.ndarray:
    """Where each of some ranges, one after another, starts, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Index:
    """BM25 weights of items, as shares of the score that an item gives itself. Items without stats are all there are."""

    def __init__(self, items: list[tuple[int, str]], k: int = WORDS, stats: Stats | None = None):
        self.k, self.ids, self.vocabulary = k, [], {}
        numbers, lengths, number = array("i"), [], self.vocabulary.setdefault
        for i, text in items:
            if words := words_of(text):
                self.ids.append(i)
                lengths.append(len(words))
                numbers.extend(number(w, len(self.vocabulary)) for w in words)
        #: The items' words as numbers, item by item.
        self.words, self.word_from = np.array(numbers, np.int32), _edges(lengths)
        n, terms, length = len(lengths), len(self.vocabulary), np.array(lengths, np.float64)
        pair, often = np.unique(np.repeat(np.arange(n), np.array(lengths, np.int64)) * max(1, terms) + self.words, return_counts=True)
        item, term = np.divmod(pair, max(1, terms))
        if stats is None:
            stats = Stats(n, np.bincount(term, minlength=terms), int(length.sum()), max(lengths, default=0))
            df = stats.df
        else:
            df = np.fromiter((stats.df[t] for t in self.vocabulary), np.int64, terms)
        self.longest = stats.longest
        raw = np.log(1 + (stats.n - df[term] + 0.5) / (df[term] + 0.5)) * often * (K1 + 1) / (often + K1 * (1 - B + B * length[item] / max(1, stats.mean)))
        by = np.lexsort((-raw, item))
        self.terms, raw = term[by].astype(np.int32), raw[by]
        #: Each item's distinct words and their weights, the weightiest first.
        self.term_from = np.searchsorted(item, np.arange(n + 1))
        own = np.add.reduceat(raw, self.term_from[:-1]) if n else raw
        self.weights = raw / own[item]
        before = np.cumsum(self.weights) - self.weights
        bound = (1 - (before - before[self.term_from[:-1]][item])).astype(np.float32)
        #: The postings, list by list: items, places among the items' words, and bounds; blocks never go from one list into the next.
        by = np.lexsort((item, self.terms))
        self.items, self.places, self.bounds = item[by].astype(np.int32), by.astype(np.int32), bound[by]
        self.listed = np.bincount(self.terms, minlength=terms)
        blocks = -(-self.listed // BLOCK)
        self.block_of = _edges(blocks)  # the first block of each list
        start, place = np.repeat(_edges(self.listed)[:-1], blocks), np.arange(self.block_of[-1]) - np.repeat(self.block_of[:-1], blocks)
        self.block_from = np.append(start + place * BLOCK, len(self.items))
        self.blocks = len(self.block_from) - 1
        self.block_best = np.maximum.reduceat(self.bounds, self.block_from[:-1]) if self.blocks else self.bounds
        self.live: dict[float, tuple[np.ndarray, np.ndarray]] = {}
        #: How many passages and postings of their words there were, blocks looked into, pivots found and items scored.
        self.work = Counter()

    def live_blocks(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The blocks whose best bound reaches the threshold, and where those of each list start among them."""
        if least not in self.live:
            live = np.flatnonzero(self.block_best >= least - SLACK)
            self.live[least] = live, np.searchsorted(live, self.block_of)
        return self.live[least]

    def parts(self, item: int) -> tuple[set, set, set]:
        """All shingles of an item, those of its question and the words of its answer."""
        w = self.words[self.word_from[item] : self.word_from[item + 1]].tolist()
        cut = len(w) - max(ANSWER_WORDS, len(w) // 4)
        both = cut >= self.k
        return shingles(w, self.k), shingles(w[:cut], self.k) if both else shingles(w, self.k), {(x,) for x in (w[cut:] if both else w)}

    def retrieve(self, passage: np.ndarray, term: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) of all items in reach, by passage; the pairs of passage and term are distinct and in order."""
        live, first = self.live_blocks(least)
        block, size = _expand(first[term], first[term + 1])
        if len(block) * BLOCK > CELLS and passage[0] < passage[-1]:
            half = np.searchsorted(passage, (passage[0] + passage[-1] + 1) // 2)
            yield from self.retrieve(passage[:half], term[:half], least)
            yield from self.retrieve(passage[half:], term[half:], least)
            return
        block, of = live[block], np.repeat(passage, size)
        posting, size = _expand(self.block_from[block], self.block_from[block + 1])
        bound = self.bounds[posting]
        reach = np.flatnonzero(bound >= least - SLACK)
        of, posting, bound = np.repeat(of, size)[reach], posting[reach], bound[reach]
        self.work.update(postings=int(self.listed[term].sum()), blocks=len(block), pivots=len(posting))
        if not len(posting):
            return
        # Which of the step's words are in which of its passages.
        lowest, known = passage[0], np.unique(term)
        table = np.zeros((passage[-1] - lowest + 1, len(known) + 1), bool)
        table[passage - lowest, np.searchsorted(known, term)] = True
        column = np.full(len(self.listed), len(known), np.int32)
        column[known] = np.arange(len(known))
        # The words after a pivot's, the weightiest first: each one that the passage lacks lowers the bound.
        pivot, place = self.items[posting], self.places[posting] + 1
        for _ in range(ROUNDS):
            more = place < self.term_from[pivot + 1]
            at = np.minimum(place, len(self.terms) - 1)
            bound = bound - self.weights[at] * (more & ~table[of - lowest, column[self.terms[at]]])
            near = np.flatnonzero(bound >= least - SLACK)
            of, pivot, place, bound = of[near], pivot[near], place[near] + 1, bound[near]
        self.work["items"] += len(pivot)
        found, sizes = set(), self.term_from[pivot + 1] - self.term_from[pivot]
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // CELLS, prepend=0, append=-1)).tolist()
        for lo, hi in zip([0, *cuts], cuts):
            if lo < hi:
                flat, size = _expand(self.term_from[pivot[lo:hi]], self.term_from[pivot[lo:hi] + 1])
                there = table[np.repeat(of[lo:hi] - lowest, size), column[self.terms[flat]]]
                near = np.flatnonzero(np.add.reduceat(self.weights[flat] * there, _edges(size)[:-1]) >= least - SLACK)
                found.update(zip(of[lo:hi][near].tolist(), pivot[lo:hi][near].tolist()))
        for p, item in sorted(found):
            here = slice(self.term_from[item], self.term_from[item + 1])
            score = math.fsum(self.weights[here][table[p - lowest, column[self.terms[here]]]])
            if score >= least - EPS:
                yield p, item, score

    def _steps(self, text: str) -> Iterator[list[str]]:
        """The words of a long text, in stretches that each repeat the last step's words of the one before."""
        if not self.ids:
            return
        text, step, held = text.lower(), self.longest, []
        most = max(2 * step, CHUNK_CHARS // 4 // step * step)
        for found in _words.finditer(text):
            held.append(found.group())
            if len(held) == most + step:
                yield held[:most]
                held = held[most - step :]
        yield held

    def search(self, text: str | None, least: float, overlap: float) -> dict[int, tuple[float, float, float, float]]:
        """Matching items of a text, each with its best (score, overlap, of question, of answer)."""
        return next(self.search_all([text], least, overlap))

    def search_all(self, texts: Iterable[str | None], least: float, overlap: float) -> Iterator[dict[int, tuple[float, float, float, float]]]:
        """What search() finds in each text, in order. Short texts are searched together, some hundred KB at a time."""
        group, chars = [], 0
        for text in texts:
            text = text or ""
            if group and (len(text) > CHUNK_CHARS or chars + len(text) > GROUP_CHARS):
                yield from self._search([words_of(t) for t in group], least, overlap)
                group, chars = [], 0
            if len(text) <= CHUNK_CHARS:
                group.append(text)
                chars += len(text)
                continue
            best: dict[int, tuple[float, float, float, float]] = {}
            for words in self._steps(text):
                for item, row in self._search([words], least, overlap)[0].items():
                    best[item] = max(best.get(item, row), row)
            yield best
        if group:
            yield from self._search([words_of(t) for t in group], least, overlap)

    def _search(self, texts: list[list[str]], least: float, overlap: float) -> list[dict[int, tuple[float, float, float, float]]]:
        out: list[dict[int, tuple[float, float, float, float]]] = [{} for _ in texts]
        if not self.ids:
            return out
        step, lengths = self.longest, np.fromiter(map(len, texts), np.int64, len(texts))
        starts, passages = _edges(lengths), np.maximum(1, -(-lengths // step) - 1)
        bases, n = _edges(passages), int(lengths.sum())
        self.work["passages"] += int(passages[lengths > 0].sum())
        ids = np.fromiter(map(self.vocabulary.get, chain.from_iterable(texts), repeat(-1)), np.int32, n)
        at = np.flatnonzero(ids >= 0)
        # Word i of a text is in its passages that start in the word's stretch of words and in the one before.
        of = np.repeat(np.arange(len(texts)), lengths)[at]
        stretch = (at - starts[of]) // step
        passage = np.concatenate([np.minimum(stretch, passages[of] - 1) + bases[of], np.maximum(stretch - 1, 0) + bases[of]])
        passage, term = np.divmod(np.unique(passage * len(self.vocabulary) + np.tile(ids[at], 2)), len(self.vocabulary))
        held, seen = -1, set()
        edges = np.searchsorted(passage, [*range(0, int(bases[-1]), STEP), int(bases[-1])]).tolist()
        for lo, hi in zip(edges, edges[1:]):
            for p, item, score in self.retrieve(passage[lo:hi], term[lo:hi], least):
                if p != held:
                    held, seen, text = p, set(), int(np.searchsorted(bases, p, "right")) - 1
                    first = int(starts[text]) + (p - int(bases[text])) * step
                    here = ids[first : min(first + 2 * step, int(starts[text + 1]))].tolist()
                # Sizes that occur: one word for answers, and the shingles of this item.
                for k in {1, min(self.k, int(self.word_from[item + 1] - self.word_from[item]))}:
                    if (k, None) not in seen:
                        seen |= shingles(here, k) | {(k, None)}
                whole, question, answer = (len(x & seen) / len(x) for x in self.parts(item))
                if whole >= overlap and question >= LEAST_QUESTION and answer >= LEAST_ANSWER:
                    out[text][item] = max(out[text].get(item, (0.0,) * 4), (score, whole, question, answer))
        return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n: items with it), and rows of term null: the number of items with words, of their words, and the longest."""
    for b in batches:
        df, n, words, longest = Counter(), 0, 0, 0
        for text in b.column(1).to_pylist():
            if w := words_of(text):
                df.update(set(w))
                n, words, longest = n + 1, words + len(w), max(longest, len(w))
        rows = [*((t, c, 0, 0) for t, c in df.items()), (None, n, words, longest)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["term", "n", "words", "longest"])


def index_shards(items: DataFrame, k: int, id_col: str, text_col: str) -> Iterator[Index]:
    """The index, in shards of about INDEX_BYTES of text; weights hang on all items, not on the shard."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    in_order = lambda part: sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    if size <= INDEX_BYTES:
        yield Index(in_order(rows), k)
        return
    shards = -(-size // INDEX_BYTES)
    rows = shared.write_table(spark, rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))), "test-items")
    counted = rows.select("shard", "text").mapInArrow(_terms, "term string, n long, words long, longest long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.max("longest").alias("longest"))
    counted = shared.write_table(spark, counted, "test-terms")
    n, words, longest = counted.where("term IS NULL").select("n", "words", "longest").first()
    for i in range(shards):
        part = rows.where(F.col("shard") == i).select("item_id", "text")
        here = part.mapInArrow(_terms, "term string, n long, words long, longest long").select("term").distinct()
        df = {r["term"]: r["n"] for r in counted.join(here, "term").select("term", "n").collect()}
        yield Index(in_order(part), k, Stats(n, df, words, longest))


def _finder(shared_index, least_score: float, least_overlap: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared_index.value
        for b in batches:
            columns = defaultdict(list)
            searched = index.search_all((t.as_py() for t in b.column(1)), least_score, least_overlap)
            for doc_id, found in zip(b.column(0), searched):
                for item, row in sorted(found.items()):
                    for name, value in zip(("doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"), (doc_id.as_py(), index.ids[item], *row)):
                        columns[name].append(value)
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if n.endswith("_id") else pa.float64()) for n, v in columns.items()], list(columns))
        shared.trim()

    return find


def contaminated(docs: DataFrame, items: DataFrame, least_score: float = LEAST_SCORE, least_overlap: float = LEAST_OVERLAP, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it contains. One shard's index is in memory at a time."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for index in index_shards(items, words, item_id_col, item_text_col):
        index.live_blocks(least_score)
        shared_index = spark.sparkContext.broadcast(index)
        part = shared.write_table(spark, keyed.mapInArrow(_finder(shared_index, least_score, least_overlap), SCHEMA), "found-items")
        shared_index.destroy()
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("score", "overlap", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _clean(shared_index, least_score: float, least_overlap: float):
    @F.arrow_udf("boolean")
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            yield pa.array([not found for found in shared_index.value.search_all((t.as_py() for t in texts), least_score, least_overlap)], pa.bool_())
        shared.trim()

    return clean


def drop_contaminated(docs: DataFrame, items: DataFrame, least_score: float = LEAST_SCORE, least_overlap: float = LEAST_OVERLAP, words: int = WORDS, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that contain no benchmark item. Without a shuffle where the index is one shard;
    each further shard writes what it leaves to the shared folder."""
    spark, held = docs.sparkSession, None
    for index in index_shards(items, words, item_id_col, item_text_col):
        if held is not None:  # there is another shard: have done with the one before
            docs = shared.write_table(spark, docs, "uncontaminated")
            held.destroy()
        index.live_blocks(least_score)
        held = spark.sparkContext.broadcast(index)
        docs = docs.where(_clean(held, least_score, least_overlap)(F.col(text_col).cast("string")))
    return docs
