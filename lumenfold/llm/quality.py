"""Quality classifier: a generalised additive model with pairwise interactions.

Features are cut into bins at the sample's quantiles. Boosting goes round the features again and again;
each step fits a shallow tree of one feature (two levels over its bins) to the current gradients and
adds a small part of it to that feature's lookup table. Then the pairs of features that explain most of
what is left get tables of their own in the same way. A score is the logistic of a sum of table cells.

Features are taken from whole texts without a shuffle; only the narrow feature table is joined with the
labels. The model is fitted on the driver on at most ``sample_rows`` labelled rows (the labels of least
hash of their id, so the same ones in every run): that is the bound on what the driver gets and on what
is broadcast.

Defined results: a null or blank text has all features zero and is scored like any other; labels that
are null, or whose id is null, teach nothing; an id labelled more than once counts once, with the least
label; documents with equal ids are each scored; with labels of one kind only every score is 0.999 or
0.001 (the share of label 1, kept off 0 and 1), and 0.5 without labels; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import shared

FEATURES = ("log_words", "word_length", "distinct_words", "top_word", "repeated_words", "distinct_pairs", "short_words", "symbols", "odd_symbols", "upper", "digits", "stops", "shouts", "spaces", "not_ascii", "distinct_lines", "log_line", "open_ends")
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_HIGH = _BYTES >= 128
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _HIGH)
_STOP = np.isin(_BYTES, list(b".,;:"))
_SHOUT = np.isin(_BYTES, list(b"!?"))
_ODD = _SYMBOL & ~np.isin(_BYTES, list(b".,;:!?'\"()-"))


def features(data: bytes) -> list[float]:
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = lambda kind: float(counts[kind].sum()) / len(data)
    seen, lines = Counter(words), [x for x in data.split(b"\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, n)
    pairs = max(1, n - 1)
    return [
        np.log1p(n), lengths.mean(), len(seen) / n, max(seen.values()) / n, sum(map(eq, words, words[1:])) / pairs,
        len(set(zip(words, words[1:]))) / pairs, (lengths <= 3).mean(), share(_SYMBOL), share(_ODD), share(_UPPER), share(_DIGIT), share(_STOP), share(_SHOUT), share(_SPACE), share(_HIGH),
        len(set(lines)) / len(lines), np.log1p(len(data) / len(lines)), sum(not x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / len(lines),
    ]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features: array<float>)"""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py() or b"") for t in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "features"])
        shared.trim()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(compute, "doc_id long, features array<float>")


class AdditiveModel:
    """Lookup tables over bins: one for each feature, and one for each chosen pair of features."""

    def __init__(self, bins: int = 32, pair_bins: int = 8, rounds: int = 120, pairs: int = 8, pair_rounds: int = 40, rate: float = 0.15, leaf: float = 4.0):
        self.bins, self.pair_bins, self.rounds, self.n_pairs, self.pair_rounds, self.rate, self.leaf = bins, pair_bins, rounds, pairs, pair_rounds, rate, leaf

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        n, k = x.shape[0], len(FEATURES)
        self.base, self.pairs = 0.0, []
        self.cuts = [np.zeros(0, np.float32)] * k
        self.coarse = [np.zeros(0, np.float32)] * k
        self.tables = [np.zeros(1)] * k
        self.pair_tables: list[np.ndarray] = []
        if not n:
            return self
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = np.log(mean / (1 - mean))
        if y.min() == y.max():
            return self
        quantiles = lambda v, b: np.unique(np.quantile(v, np.arange(1, b) / b)).astype(np.float32)
        self.cuts = [quantiles(x[:, j], self.bins) for j in range(k)]
        self.coarse = [quantiles(x[:, j], self.pair_bins) for j in range(k)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        cells = self._cells(x, self.cuts)
        total = np.full(n, self.base)
        for _ in range(self.rounds):
            for j in range(k):
                g, h = self._gradients(total, y)
                step = self._tree(np.bincount(cells[j], g, len(self.tables[j])), np.bincount(cells[j], h, len(self.tables[j])), 2) * self.rate
                self.tables[j] += step
                total += step[cells[j]]
        coarse = self._cells(x, self.coarse)
        shape = lambda a, b: (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
        grid = lambda a, b, v: np.bincount(coarse[a] * shape(a, b)[1] + coarse[b], v, shape(a, b)[0] * shape(a, b)[1]).reshape(shape(a, b))
        g, h = self._gradients(total, y)
        gains = sorted(((self._square(grid(a, b, g), grid(a, b, h))[1], a, b) for a, b in combinations(range(k), 2)), reverse=True)
        self.pairs = [(a, b) for gain, a, b in gains[: self.n_pairs] if gain > 0]
        self.pair_tables = [np.zeros(shape(a, b)) for a, b in self.pairs]
        for _ in range(self.pair_rounds):
            for (a, b), table in zip(self.pairs, self.pair_tables):
                g, h = self._gradients(total, y)
                step = self._square(grid(a, b, g), grid(a, b, h))[0] * self.rate
                table += step
                total += step[coarse[a], coarse[b]]
        return self

    @staticmethod
    def _gradients(total: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    @staticmethod
    def _cells(x: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]

    def _value(self, g, h):
        return g / (h + self.leaf)

    def _tree(self, g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
        """Values of the leaves over the bins of one feature."""
        if depth and len(g) > 1:
            gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
            gain = gl**2 / (hl + self.leaf) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.leaf)
            at = int(gain.argmax()) + 1
            if gain[at - 1] > g.sum() ** 2 / (h.sum() + self.leaf) + 1e-9:
                return np.concatenate([self._tree(g[:at], h[:at], depth - 1), self._tree(g[at:], h[at:], depth - 1)])
        return np.full(len(g), self._value(g.sum(), h.sum()))

    def _square(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """Values of the best four leaves that one cut of each feature makes, and their gain."""
        if min(g.shape) < 2:
            return np.zeros(g.shape), 0.0
        cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

        def quarters(c):
            a = c[:-1, :-1]
            top, left = c[:-1, -1:] - a, c[-1:, :-1] - a
            return np.stack([a, top, left, c[-1, -1] - a - top - left])

        qg, qh = quarters(cg), quarters(ch)
        gain = (qg**2 / (qh + self.leaf)).sum(0) - cg[-1, -1] ** 2 / (ch[-1, -1] + self.leaf)
        i, j = np.unravel_index(gain.argmax(), gain.shape)
        v = self._value(qg[:, i, j], qh[:, i, j])
        out = np.empty(g.shape)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
        return out, float(gain[i, j])

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for table, cell in zip(self.tables, self._cells(x, self.cuts)):
            total += table[cell]
        coarse = self._cells(x, self.coarse)
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def held_out(id_col: str = "doc_id"):
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def known_labels(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) to learn from, never of held-out rows: those of least hash of their id, sample_rows at most."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """A model from labelled feature rows (doc_id, features, label)."""
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample_rows).select("features", "label").collect()
    x = np.array([r["features"] for r in sample], np.float32).reshape(len(sample), len(FEATURES))
    return AdditiveModel().fit(x, np.array([float(r["label"] > 0) for r in sample]))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, label_id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document."""
    rows = shared.write_table(spark, feature_table(docs, id_col, text_col), "features")
    # The labels are sample_rows at most.
    model = fit(rows.join(F.broadcast(known_labels(labels, id_col=label_id_col, sample_rows=sample_rows)), "doc_id"), sample_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).values.to_numpy().reshape(-1, len(FEATURES)) if b.num_rows else np.zeros((0, len(FEATURES)), np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["doc_id", "score"])
        shared.trim()

    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, label_id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that the classifier accepts, with their columns.

    The model needs the features of labelled documents alone, which are found first, by ids that are
    sample_rows at most; all documents' features are then computed once, beside each row, without a shuffle
    of the texts, and so that rows with equal ids are told apart."""
    known = known_labels(labels, id_col=label_id_col, sample_rows=sample_rows)
    taught = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    model = fit(feature_table(taught).join(F.broadcast(known), "doc_id"), sample_rows)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            x = np.array([features(t.as_py() or b"") for t in texts.cast(pa.binary())], np.float32).reshape(-1, len(FEATURES))
            yield pa.array(model.score(x))
        shared.trim()

    return docs.where(score(F.col(text_col).cast("string")) >= threshold)
