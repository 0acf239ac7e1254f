import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import importance as I  # noqa: E402
from lumenfold.llm import queries as Q  # noqa: E402

DATA = "/root/testdata/sf0.001"


def brute(text, buckets=10_000):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return len(words), sorted(zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(words) - k + 1))


@pytest.mark.parametrize("piece", [1, 3, 10, 1 << 20])
def test_ring(monkeypatch, piece):
    monkeypatch.setattr(I, "CHUNK_BYTES", piece)
    rng = random.Random(piece)
    for text in ["", " ", "a", "a-b", "É É x1 ÀB", "one_two\x7fthree  İi", *("".join(rng.choice("aB9é  -\n") for _ in range(n)) for n in (5, 50, 400))]:
        words, found = I.features(text.encode())
        assert (words, found.tolist()) == brute(text)
        assert I._load(I._store(found)).tolist() == found.tolist()


def expected(docs, items, min_words=20, share=5, buckets=10_000):
    found = [brute(t, buckets) for _, t in docs]
    corpus, target = (Counter(b for _, f in x for b in f) for x in (found, [brute(t, buckets) for t in items]))
    every, some = sum(corpus.values()) + buckets, sum(target.values()) + buckets
    gain = [math.floor(1000 * math.log((target[b] + 1) * every / ((corpus[b] + 1) * some))) for b in range(buckets)]
    rows = []
    for (doc_id, _), (words, f) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: share * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_query_on_whole_tables(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = sorted((tuple(r) for r in Q.op13(spark, DATA).collect()), key=str)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs], [r["text"] for r in items])
    assert sum(r[4] is not None for r in got) == 5 * sum(brute(r["text"])[0] >= 20 for r in docs) // 100 > 0


def test_cases(spark):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, "-- !"), (None, "a b c"), (4, "x y " * 100_000)] + [(i, " ".join(rng.choices("abcdefgh", k=6))) for i in range(10, 200)]
    rows += [rows[-1]] * 3  # ties of score and id
    docs = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "doc_id long, text string, rank int, stored binary").repartition(5)
    target = spark.createDataFrame([("a b a b c",), (None,)], "text string")
    got = I.resample(spark, docs, target, buckets=50, min_words=1, share=60).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = expected(rows, ["a b a b c", None], 1, 60, 50)
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 60 * 192 // 100 + 1)) or len(ranks) == 60 * sum(brute(t)[0] >= 1 for _, t in rows) // 100
    unique = [i for i, _ in rows if [x for x, _ in rows].count(i) == 1]
    assert sorted((tuple(r) for r in got if r["doc_id"] in unique), key=str) == [r for r in want if r[0] in unique]
    assert len(got) == len(rows)
    assert I.resample(spark, docs.limit(0), target).count() == 0
    assert I.resample(spark, docs, target.limit(0), min_words=1, share=100).where("rank IS NOT NULL").count() == len(ranks) * 0 + sum(brute(t)[0] >= 1 for _, t in rows)


def test_ranks_span_partitions(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "1L AS n_words", "1L AS n_features", "0L AS weight", "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 50 END AS score")
    got = I.ranked(spark, rows, 5000, 5000).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [(r["score"], r["doc_id"]) for r in got] == sorted(((r["score"], r["doc_id"]) for r in got), key=lambda x: (-x[0], x[1]))
