import hashlib
import random
import re

import pytest
import xxhash

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import fingerprints as P  # noqa: E402


def brute_fp(text):
    votes, total = [0] * 64, 0
    for w in re.split(P.SPACE, text.lower()):
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        total += len(w)
        for b in range(64):
            votes[b] += len(w) * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        e = t[: len(t) - q] + n[:q]
        a, b, c = map(brute_fp, (t, e, n))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", 1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64))
    return out


def test_edits(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "of", "Österreich", "naïve", "x", "數據", "😀😀"]) + str(rng.randrange(40))
    rows = [(i * 50 - 900, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(None, "null id"), (None, None), (10**12, ""), (10**12 + 1, " \n\t"), (7, "tie b"), (7, "tie a"), (7, "tie a"), (-(10**15), "w " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, part string, fp int")
    got = [tuple(r)[:7] for r in P.fingerprint_edits(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_one_and_none(spark):
    one = spark.createDataFrame([(5, "abc def ghi")], "doc_id long, text string")
    assert [tuple(r)[:7] for r in P.fingerprint_edits(one).collect()] == brute([(5, "abc def ghi")])
    assert P.fingerprint_edits(one.limit(0)).count() == 0


@pytest.mark.parametrize("radius,blocks", [(0, 1), (1, 3), (3, 6)])
def test_search_finds_all(spark, radius, blocks):
    rng = random.Random(radius)
    fps = set()
    for c in [rng.getrandbits(64) for _ in range(10)]:
        for _ in range(20):
            x = c
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    df = spark.createDataFrame([(P._signed(f),) for f in fps] * 2, "fp long")
    got = {(r["q"] % 2**64, r["fp"] % 2**64, r["distance"]) for r in P.find_within(df, df, radius, blocks).collect()}
    assert got == {(a, b, (a ^ b).bit_count()) for a in fps for b in fps if (a ^ b).bit_count() <= radius}


def test_documents_within(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        x = 0x123456789ABCDEF0 if i % 2 else 0xF0F0F0F00F0F0F0F
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        rows.append((i, P._signed(x), "kept"))
    rows += [(None, rows[0][1], "kept")]
    df = spark.createDataFrame(rows, "doc_id long, fp long, extra string")
    got = {(r["doc_id"], r["extra"]): r["n_within"] for r in P.documents_within(df, df["doc_id"] % 10 == 0).collect()}
    near = lambda x: sum((x % 2**64 ^ y % 2**64).bit_count() <= 3 for _, y, _ in rows) - 1
    assert got == {(i, "kept"): near(x) if i is not None and i % 10 == 0 else None for i, x, _ in rows}


def test_next_with_hashed_ids_and_one_id_repeated(spark):
    rng = random.Random(8)
    rows = [(rng.getrandbits(64) - (1 << 63), f"h{i}") for i in range(3000)] + [(77, f"same {rng.randrange(50)}") for _ in range(10_000)] + [(i, f"d{i}") for i in range(3000)] + [(None, "n2"), (None, "n1")]
    rng.shuffle(rows)
    got = P.with_next(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text", "next_id", "next_text").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = [(*r, *n) for r, n in zip(rows, rows[1:] + rows[:1])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
