import math
import random
import re
import zlib

import pytest

pytest.importorskip("lumenfold.llm")

import numpy as np  # noqa: E402

from lumenfold.llm import quality as Q  # noqa: E402

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in Q.classify(spark, docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    test = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in test]) >= 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic AS lang")
    key = lambda rows: sorted((r["doc_id"], r["score"]) for r in rows)
    few = docs.where("doc_id < 300")
    assert key(Q.classify(spark, few, labels).collect()) == key(Q.classify(spark, few, flipped).collect())


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.1), (2, " \n", None), (None, "a b", 1.0), (3, "x " * 100_000, 2.0)], "doc_id long, text string, score double")
    for labels in ([], [(1, 1)], [(1, 0), (1, 1), (3, None), (None, 1)]):
        got = Q.classify(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(got) == 5 and all(r["score"] is not None and r["held_out"] is not None for r in got)
    assert Q.classify(spark, docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(Q.FEATURES)), np.float32)
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = Q.AdditiveModel(rounds=20).fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_keep_good(spark):
    rng = random.Random(2)
    good = lambda: " ".join(f"word{rng.randrange(500)}" for _ in range(80)) + "."
    bad = lambda: "$$$ " * 60
    rows = [(i, good() if i % 3 else bad(), "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int")
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(300) if i % 3]


def brute_features(text):
    words = [w for w in re.split(r"[ \t\n\r\x0b\x0c]+", text or "") if w]
    if not words:
        return [0.0] * 18
    data = (text or "").encode()
    size, n = len(data), len(words)
    blen = [len(w.encode()) for w in words]
    share = lambda f: sum(1 for b in data if f(b)) / size
    space = lambda b: chr(b) in " \t\n\r\x0b\x0c"
    symbol = lambda b: b < 128 and not chr(b).isalnum() and not space(b)
    pairs = list(zip(words, words[1:]))
    lines = [x for x in (text or "").split("\n") if x]
    return [
        math.log1p(n), sum(blen) / n, len(set(words)) / n, max(words.count(w) for w in set(words)) / n, sum(a == b for a, b in pairs) / max(1, n - 1),
        len(set(pairs)) / max(1, n - 1), sum(x <= 3 for x in blen) / n, share(symbol), share(lambda b: symbol(b) and chr(b) not in ".,;:!?'\"()-"),
        share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: chr(b) in ".,;:"), share(lambda b: chr(b) in "!?"), share(space), share(lambda b: b >= 128),
        len(set(lines)) / len(lines), math.log1p(size / len(lines)), sum(not x.rstrip(" \t\n\r\x0b\x0c").endswith((".", "!", "?", ":")) for x in lines) / len(lines),
    ]


def brute_model(x, y, bins, pair_bins, rounds, n_pairs, pair_rounds, rate, leaf):
    """Row by row: bins by quantiles, cyclic boosting of two-level trees, then of the best pairs."""
    n, k = len(x), len(x[0])

    def quantiles(v, b):
        v, out = sorted(v), []
        for i in range(1, b):
            at = (len(v) - 1) * i / b
            lo = min(int(at), len(v) - 2)
            out.append(np.float32(v[lo] + (v[lo + 1] - v[lo]) * (at - lo)))
        return sorted(set(out))

    cell = lambda cuts, value: sum(c <= value for c in cuts)
    value = lambda g, h: g / (h + leaf)
    score = lambda g, h: g * g / (h + leaf)

    def tree(g, h, depth):
        if depth and len(g) > 1:
            gains = [score(sum(g[:i]), sum(h[:i])) + score(sum(g[i:]), sum(h[i:])) for i in range(1, len(g))]
            at = max(range(len(gains)), key=lambda i: (round(gains[i], 12), -i)) + 1
            if gains[at - 1] > score(sum(g), sum(h)) + 1e-9:
                return tree(g[:at], h[:at], depth - 1) + tree(g[at:], h[at:], depth - 1)
        return [value(sum(g), sum(h))] * len(g)

    def square(g, h):
        best = None
        for i in range(1, len(g)):
            for j in range(1, len(g[0])):
                total = lambda m, a, b: sum(sum(r[b]) for r in m[a])
                q = [(total(g, a, b), total(h, a, b)) for a in (slice(0, i), slice(i, None)) for b in (slice(0, j), slice(j, None))]
                gain = sum(score(*p) for p in q) - score(total(g, slice(None), slice(None)), total(h, slice(None), slice(None)))
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, i, j, [value(*p) for p in q])
        return best

    cuts = [quantiles([float(r[j]) for r in x], bins) for j in range(k)]
    coarse = [quantiles([float(r[j]) for r in x], pair_bins) for j in range(k)]
    mean = min(max(sum(y) / n, 1e-3), 1 - 1e-3)
    base = math.log(mean / (1 - mean))
    total, tables, grids = [base] * n, [[0.0] * (len(c) + 1) for c in cuts], {}
    gradient = lambda: [(t - 1 / (1 + math.exp(-s)), (1 / (1 + math.exp(-s))) * (1 - 1 / (1 + math.exp(-s)))) for s, t in zip(total, y)]

    def sums(a, b):
        g, h = ([[0.0] * (len(coarse[b]) + 1) for _ in range(len(coarse[a]) + 1)] for _ in "gh")
        for r, (gi, hi) in zip(x, gradient()):
            i, j = cell(coarse[a], r[a]), cell(coarse[b], r[b])
            g[i][j] += gi
            h[i][j] += hi
        return g, h

    for _ in range(rounds):
        for j in range(k):
            g, h = [0.0] * len(tables[j]), [0.0] * len(tables[j])
            for r, (gi, hi) in zip(x, gradient()):
                g[cell(cuts[j], r[j])] += gi
                h[cell(cuts[j], r[j])] += hi
            step = [rate * v for v in tree(g, h, 2)]
            tables[j] = [t + s for t, s in zip(tables[j], step)]
            total = [t + step[cell(cuts[j], r[j])] for t, r in zip(total, x)]
    found = []
    for a in range(k):
        for b in range(a + 1, k):
            if coarse[a] and coarse[b]:
                found.append((square(*sums(a, b))[0], a, b))
    for gain, a, b in sorted(found, reverse=True)[:n_pairs]:
        if gain > 0:
            grids[a, b] = [[0.0] * (len(coarse[b]) + 1) for _ in range(len(coarse[a]) + 1)]
    for _ in range(pair_rounds):
        for (a, b), grid in grids.items():
            _, i, j, v = square(*sums(a, b))
            part = lambda p, q: rate * v[2 * (p >= i) + (q >= j)]
            total = [t + part(cell(coarse[a], r[a]), cell(coarse[b], r[b])) for t, r in zip(total, x)]
            grids[a, b] = [[t + part(p, q) for q, t in enumerate(row)] for p, row in enumerate(grid)]

    def predict(r):
        s = base + sum(t[cell(c, v)] for t, c, v in zip(tables, cuts, r)) + sum(g[cell(coarse[a], r[a])][cell(coarse[b], r[b])] for (a, b), g in grids.items())
        return 1 / (1 + math.exp(-s))

    return predict


def test_features_equal_brute_force():
    rng = random.Random(7)
    texts = [None, "", " \n\t", "One.", "a\x0bb\x0cc\rd", "né ñandú 數據!", "x x x x\nx x\n\n  y?", "A1 $$ (b) 'c' \"d\" - e; f: g\n"]
    texts += [" ".join(rng.choice(["The", "cat,", "sat.", "on1", "##", "ü", "\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    for t in texts:
        assert np.allclose(Q.features((t or "").encode()), brute_features(t), rtol=1e-9, atol=1e-12), t


def test_scores_equal_brute_force(spark, monkeypatch):
    """The whole operator against bins, tables and scores computed row by row."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(260)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    setting = dict(bins=6, pair_bins=3, rounds=2, pairs=2, pair_rounds=2, rate=0.15, leaf=4.0)
    monkeypatch.setattr(Q.AdditiveModel.__init__, "__defaults__", tuple(setting.values()))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    x = {i: [np.float32(v) for v in brute_features(t)] for i, t in texts.items()}
    taught = sorted((r["doc_id"], r["quality"]) for r in labels.collect() if r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2)
    assert len(taught) > 50 and len({q for _, q in taught}) == 2
    predict = brute_model([x[i] for i, _ in taught], [float(q) for _, q in taught], 6, 3, 2, 2, 2, 0.15, 4.0)
    got = {r["doc_id"]: r["score"] for r in Q.classify(spark, docs, labels).collect()}
    assert got.keys() == texts.keys()
    assert max(abs(got[i] - predict(x[i])) for i in texts) < 1e-6


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "good words here." if i % 2 else "$$$ $$$") for i in range(200)], "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "key long, quality int")
    assert Q.known_labels(labels, id_col="key", sample_rows=30).count() == 30
    got = Q.classify(spark, docs, labels, id_col="id", label_id_col="key", sample_rows=60).collect()
    assert len(got) == 200 and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    assert Q.keep_good(docs, labels, id_col="id", label_id_col="key", sample_rows=60).count() == 100
