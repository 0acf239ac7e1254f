import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("lumenfold.llm")

import numpy as np  # noqa: E402

from lumenfold.llm import periodic_runs as P  # noqa: E402
from lumenfold.llm import queries as Q  # noqa: E402

DATA = "/root/testdata/sf0.001"


def brute(words, min_words=6, min_periods=4):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(min_words, min_periods * q) and not any(q % d == 0 and words[s : e + q - d] == words[s + d : e + q] for d in range(1, q)):
                out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words, **more):
    return P.find_runs(P.numbers([w.encode() for w in words]), **more)


@pytest.mark.parametrize("seed", range(60))
def test_small_alphabets(seed):
    rng = random.Random(seed)
    words = [rng.choice("ab" if seed % 3 else "abcde") for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(4)):  # periodic parts, nested in each other
        at, q = rng.randrange(len(words) + 1), rng.randrange(1, 12)
        words[at:at] = (words[at : at + q] or ["x"]) * rng.randrange(2, 9)
    assert found(words) == brute(words)
    assert found(words, min_words=2, min_periods=3) == brute(words, 2, 3)


@pytest.mark.parametrize("q", [1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 63, 64, 100])
def test_lengths_about_the_limit(q):
    rng = random.Random(q)
    root = [f"w{rng.randrange(10 * q)}" for _ in range(q - 1)] + ["end"]
    for length in range(max(6, 4 * q) - 2, max(6, 4 * q) + 3):
        words = ["x", "y", "z"] + (root * 8)[:length] + ["u"]
        assert found(words) == brute(words), length
    assert found((root * 40)) == [(0, 40 * q, q)] if q > 1 else True


def test_long_runs_stay_cheap():
    words = ["a"] * 300_000 + ["b"] + ["c", "d", "e"] * 100_000
    assert found(words) == [(0, 300_000, 1), (300_001, 300_000, 3)]
    assert not P._repeats(np.arange(97)) and P._repeats(np.tile(np.arange(7), 5))


def test_kept_words():
    assert P.kept_words(9, [(1, 6, 1), (2, 6, 2)]).tolist() == [True, True] + [False] * 6 + [True]


def test_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (None, "é é é é é é x", 1), (4, "a b " * 3, 2), (4, "a b " * 3, 2), (5, "k " + "a b " * 4 + "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.with_runs(docs).collect()), key=str)
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (0, 7, [(0, 6, 1)], "é x"), *[(4, 6, [], "a b a b a b")] * 2, (5, 10, [(1, 8, 2)], "k a b z")], key=str)
    assert P.with_runs(docs.limit(0)).count() == 0


def expected(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs, best, gone = brute(words), None, set()
    for s, length, q in runs:
        best = (s, length, q) if best is None or length * best[2] > best[1] * q else best
        gone |= set(range(s + q, s + length))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *shown, digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = sorted(tuple(r) for r in Q.op11(spark, DATA).collect())
    assert got == sorted(expected(r["doc_id"], r["text"]) for r in docs)
    assert sum(r[1] > 0 for r in got) > 10
