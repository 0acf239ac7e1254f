"""LM scoring by cross-entropy difference.

Two bigram models with additive smoothing, one of the target documents and one of all documents, share
one vocabulary: every word of the corpus. They are matched: the background's counts are scaled to the
target's number of tokens, so both have the same mass beside the same smoothing. A document's score is
its mean loss per token under the background less that under the target: the higher, the more like the
target. A document's own words are taken out of both models before it is scored.

log P(w | v) is a term of the bigram (v, w) less a term of its history v, so a document's loss is a sum
over its distinct bigrams and histories, each with its count. These grams travel once, packed by bucket,
to the task that holds all their counts; what comes back, packed again by document, is one partial sum
a document and task. A common
gram sends one entry for each document that has it, never one for each occurrence; grams that would fill
a quarter of a task are counted in advance and scored where the documents are. Grams are hashes of
as many bits as keep the expected share of grams that collide below 2^-20 at the corpus's size.

Defined results: words are lower-cased (A-Z) runs between ASCII white space; texts without words have
no tokens and score 0; rows with equal ids (null is an id, and one with -2^62) are each left out
and scored by themselves, and their sums give one row; ids that
are not in docs are no target; without target tokens all scores are 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared

BETA = 0.05
BLOCK_BYTES = 8 << 20
SURVEY_BYTES = 32 << 20
#: Bits of a gram's hash beyond those that number the corpus's grams.
SPARE_BITS = 20
#: Gram entries for a task.
ENTRIES_A_TASK = 6_000_000
#: A gram with so many entries is hot; a sample of so many tokens finds such grams, by so many at least.
HOT_ENTRIES, SAMPLE_TOKENS, HOT_LEAST = ENTRIES_A_TASK // 4, 2_000_000, 64
#: Documents whose partial sums are added in a task.
DOCS_A_TASK = 500_000
LEAST = -(1 << 62)
_START = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the bigrams (last bit 0) and histories (last bit 1) of a text, one of each for a word."""
    history = np.concatenate([[_START], words[:-1]]) if len(words) else words
    pairs = blobs.mix(history * np.uint64(0xD6E8FEB86659FD93) + words)
    return np.concatenate([pairs & ~np.uint64(1), blobs.mix(history + np.uint64(77)) | np.uint64(1)])


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each key, rising with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[int], list[bool], list[np.ndarray]]]:
    """Ids, target flags and word hashes of some MB of texts at a time."""
    ids, flags, words, size = [], [], [], 0
    for b in batches:
        for doc_id, flag, text in zip(b.column(0), b.column(1), b.column(2).cast(pa.binary())):
            data = text.as_py() or b""
            ids.append(doc_id.as_py())
            flags.append(flag.as_py())
            words.append(word_hashes(data))
            size += len(data)
            if size >= most:
                yield ids, flags, words
                ids, flags, words, size = [], [], [], 0
    if ids:
        yield ids, flags, words


def _survey(n: int):
    """Rows of bucket -1: ids and numbers of tokens; others: distinct words."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, words in _blocks(batches, SURVEY_BYTES):
            rows = [(-1, blobs.pack(np.array(ids, np.int64), np.array(list(map(len, words)), np.int64)))]
            seen = np.unique(blobs.mix(np.concatenate(words)))
            rows += [(i, blobs.pack(w)) for i, (w,) in blobs.cut(_buckets(seen, n), seen)]
            yield blobs.batch(rows)

    return survey


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(0, np.uint64)
    for b in batches:
        new = [blobs.unpack(x.as_py())[0] for x in b.column(1)]
        seen = np.unique(np.concatenate([seen, *new]))
    yield pa.RecordBatch.from_arrays([pa.array([len(seen)])], ["n"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column(1):
            ids, n = blobs.unpack(x.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["doc_id", "n"])


class Plan:
    """What the tasks need to know: bits of a gram, the models' constants, and the counts of hot grams."""

    def __init__(self, buckets: int, bits: int, scale: float, vocabulary: int, beta: float, doc_buckets: int):
        self.buckets, self.bits, self.scale, self.vocabulary, self.beta, self.doc_buckets = buckets, bits, scale, vocabulary, beta, doc_buckets
        # The first bits spread the grams over the buckets, the last one is the kind.
        self.mask = np.uint64((1 << 64) - (1 << 64 - bits) | 1)
        self.hot, self.hot_all, self.hot_target = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)

    def losses(self, history: np.ndarray, target: np.ndarray, every: np.ndarray, count: np.ndarray, flagged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of the losses under the target and the background, of grams with these counts in the
        corpus that a document has count times itself."""
        smooth = np.where(history, self.beta * self.vocabulary, self.beta)
        sign = np.where(history, count, -count)
        return sign * np.log(target - count * flagged + smooth), sign * np.log(self.scale * (every - count) + smooth)


def _entries(words: list[np.ndarray], mask: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, document, count), ordered by gram and document, of the documents of a block."""
    grams = [_grams(w) for w in words]
    doc = np.repeat(np.arange(len(words), dtype=np.int32), list(map(len, grams)))
    gram = np.concatenate(grams) & mask
    order = np.argsort(gram, kind="stable")  # documents stay in order within a gram
    gram, doc = gram[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])])) if len(gram) else np.zeros(0, np.int64)
    return gram[first], doc[first], np.diff(np.append(first, len(gram))).astype(np.uint32)


def _sampled_grams(plan: Plan):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, words in _blocks(batches, BLOCK_BYTES):
            gram, n = np.unique(_entries(words, plan.mask)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)[n > 1]), pa.array(n[n > 1])], ["gram", "n"])

    return sample


def _hot_counts(plan: Plan):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, target = np.zeros(len(plan.hot)), np.zeros(len(plan.hot))
        for _, flags, words in _blocks(batches, BLOCK_BYTES):
            gram, doc, n = _entries(words, plan.mask)
            at = np.minimum(np.searchsorted(plan.hot, gram), len(plan.hot) - 1)
            hit = plan.hot[at] == gram
            every += np.bincount(at[hit], n[hit], len(plan.hot))
            target += np.bincount(at[hit], n[hit] * np.array(flags, bool)[doc[hit]], len(plan.hot))
        yield pa.RecordBatch.from_arrays([pa.array(plan.hot.view(np.int64)), pa.array(every), pa.array(target)], ["gram", "every", "target"])

    return count


def find_hot_grams(plan: Plan, docs: DataFrame, flagged: DataFrame, tokens: int) -> None:
    """Give the plan the counts of grams whose entries would fill a quarter of a task: they are counted in
    advance, with partial sums, and scored where the documents are. A sample of documents says which
    grams these are, which only plans where work is done: results are the same for any list."""
    share = max(1, tokens // SAMPLE_TOKENS)
    sampled = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).mapInArrow(_sampled_grams(plan), "gram long, n long")
    sampled = sampled.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= max(HOT_LEAST, HOT_ENTRIES // share))
    plan.hot = np.sort(np.array([r["gram"] for r in sampled.orderBy(F.desc("n"), "gram").limit(4 * plan.buckets).collect()], np.int64).view(np.uint64))
    if len(plan.hot):
        rows = flagged.mapInArrow(_hot_counts(plan), "gram long, every double, target double").groupBy("gram").agg(F.sum("every").alias("every"), F.sum("target").alias("target")).collect()
        counts = {np.int64(r["gram"]).view(np.uint64): (r["every"], r["target"]) for r in rows}
        plan.hot_all, plan.hot_target = (np.array([counts[g][i] for g in plan.hot]) for i in (0, 1))


def _emit(plan: Plan):
    n, bits = plan.buckets, plan.bits

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flags, words in _blocks(batches, BLOCK_BYTES):
            gram, doc, count = _entries(words, plan.mask)
            doc_ids, target, rows = np.array(ids, np.int64), np.array(flags, bool), []
            if len(plan.hot):
                place = np.minimum(np.searchsorted(plan.hot, gram), len(plan.hot) - 1)
                hit = plan.hot[place] == gram
                parts = plan.losses((gram[hit] & np.uint64(1)).astype(bool), plan.hot_target[place[hit]], plan.hot_all[place[hit]], count[hit].astype(float), target[doc[hit]])
                gram, doc, count, scored = gram[~hit], doc[~hit], count[~hit], doc[hit]
                rows.append((int(blobs.mix(doc_ids[:1])[0] % np.uint64(n)), blobs.pack(doc_ids, *(np.bincount(scored, p, len(ids)) for p in parts))))
            at = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
            with_docs = np.diff(np.append(at, len(gram))).astype(np.uint32)
            bucket = _buckets(gram[at], n)
            ends = np.searchsorted(bucket, np.arange(n + 1))
            entry = np.append(at, len(gram))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                a, b = ends[i], ends[i + 1]
                rows_of = slice(entry[a], entry[b])
                here, local = np.unique(doc[rows_of], return_inverse=True)
                keys = gram[at[a:b]] >> np.uint64(65 - bits) << np.uint64(1) | gram[at[a:b]] & np.uint64(1)
                steps = np.diff(keys, prepend=np.uint64(0))
                # Byte planes: the high bytes of the steps are zeros, which compress away.
                rows.append((i, blobs.pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T), with_docs[a:b], local.astype(np.uint16 if len(here) < 1 << 16 else np.uint32), count[rows_of], doc_ids[here], target[here])))
            yield blobs.batch(rows)

    return emit


def _score(plan: Plan):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ready = [], []
        for b in batches:
            for x in b.column(1):
                columns = blobs.unpack(x.as_py())
                (ready if len(columns) == 3 else parts).append(columns)
        if not parts and not ready:
            return
        parts = parts or [[np.zeros((0,), np.uint8), *(np.zeros(0, k) for k in (np.uint32, np.uint16, np.uint32, np.int64, bool))]]
        grams = [np.cumsum(np.ascontiguousarray(p[0].reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64) for p in parts]
        distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
        which, edges = which.astype(np.int32), np.cumsum([0, *map(len, grams)])
        del grams
        all_c, target_c = np.zeros(len(distinct)), np.zeros(len(distinct))
        for p, a, b in zip(parts, edges, edges[1:]):
            gram = np.repeat(which[a:b], p[1])
            np.add.at(all_c, gram, p[3])
            flagged = p[5][p[2]]
            np.add.at(target_c, gram[flagged], p[3][flagged])
        history = (distinct & np.uint64(1)).astype(bool)
        names = np.concatenate([p[4] for p in parts])
        sums = np.zeros((2, len(names)))  # loss under the target, loss under the background
        base = 0
        for p, a, b in zip(parts, edges, edges[1:]):
            gram, c, flagged = np.repeat(which[a:b], p[1]), p[3].astype(float), p[5][p[2]]
            is_history = history[gram]
            losses = plan.losses(is_history, target_c[gram], all_c[gram], c, flagged)
            for row, values in zip(sums, losses):
                row[base : base + len(p[4])] += np.bincount(p[2], values, len(p[4]))
            base += len(p[4])
        ids, sums = _added(np.concatenate([names, *(r[0] for r in ready)]), np.concatenate([sums, *(np.stack(r[1:]) for r in ready)], axis=1))
        for bucket, (i, t, b) in blobs.cut((blobs.mix(ids) % np.uint64(plan.doc_buckets)).astype(np.int32), ids, *sums):
            yield blobs.batch([(bucket, blobs.pack(i, t, b))])
        shared.trim()

    return score


def _added(ids: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, inverse = np.unique(ids, return_inverse=True)
    return names, np.stack([np.bincount(inverse, row, len(names)) for row in sums])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of packed partial sums."""
    ids, sums, held, size = np.zeros(0, np.int64), np.zeros((2, 0)), [], 0
    for b in batches:
        for x in b.column(1):
            held.append(blobs.unpack(x.as_py()))
            size += len(held[-1][0])
            if size > max(1_000_000, len(ids)):
                ids, sums = _added(np.concatenate([ids, *(h[0] for h in held)]), np.concatenate([sums, *(np.stack(h[1:]) for h in held)], axis=1))
                held, size = [], 0
    ids, sums = _added(np.concatenate([ids, *(h[0] for h in held)]), np.concatenate([sums, *(np.stack(h[1:]) for h in held)], axis=1))
    for i in range(0, len(ids), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in (ids, *sums)], ["doc_id", "target", "background"])


def cross_entropy_difference(spark: SparkSession, docs: DataFrame, target_ids: DataFrame, beta: float = BETA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score); target_ids has a column of the id's name."""
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    target = target_ids.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_id"), F.lit(True).alias("is_target")).distinct()
    n = shared.partitions(spark)
    plain = keyed.select("doc_id", F.lit(False).alias("is_target"), "text")
    path = shared.new_path(spark, "words")
    survey = shared.write_table(spark, plain.mapInArrow(_survey(n), blobs.SCHEMA), "words", path)
    vocabulary = blobs.deal(survey.where("bucket >= 0"), n).mapInArrow(_distinct, "n long").agg(F.sum("n")).first()[0] or 0
    lengths = survey.where("bucket < 0").mapInArrow(_tokens, "doc_id long, n long").groupBy("doc_id").agg(F.sum("n").alias("n"))
    lengths = shared.write_table(spark, lengths, "lengths")
    totals = lengths.join(target, "doc_id", "left").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("all"), F.sum(F.when(F.col("is_target"), F.col("n"))).alias("target")).first()
    shared.drop_path(spark, path)
    tokens, target_tokens = totals["all"] or 0, totals["target"] or 0
    buckets = max(n, -(-2 * tokens // ENTRIES_A_TASK))
    bits = min(64, (2 * tokens).bit_length() + SPARE_BITS)
    # The target's ids grow with the corpus: the plan is one for tables that can't be broadcast.
    flagged = keyed.join(target.hint("merge"), "doc_id", "left").select("doc_id", F.coalesce("is_target", F.lit(False)).alias("is_target"), "text")
    doc_buckets = max(n, -(-totals["docs"] // DOCS_A_TASK))
    plan = Plan(buckets, bits, target_tokens / max(1, tokens), vocabulary, beta, doc_buckets)
    find_hot_grams(plan, plain, flagged, tokens)
    dealt = blobs.deal(flagged.mapInArrow(_emit(plan), blobs.SCHEMA), buckets)
    parts = dealt.mapInArrow(_score(plan), blobs.SCHEMA)
    sums = blobs.deal(parts, doc_buckets).mapInArrow(_add, "doc_id long, target double, background double")
    every = lengths.join(sums, "doc_id", "left")
    per_token = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("n")), F.lit(0.0))
    score = per_token("background") - per_token("target") if target_tokens else F.lit(0.0)
    return every.select(F.when(F.col("doc_id") != LEAST, F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_tokens"), per_token("target").alias("target_loss"), per_token("background").alias("background_loss"), score.alias("score"))
