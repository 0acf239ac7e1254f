import random

import pytest
import xxhash

pytest.importorskip("lumenfold.llm")

import numpy as np  # noqa: E402

from lumenfold.llm import simhash_dedup as S  # noqa: E402
from lumenfold.llm.components import connected_components  # noqa: E402


def brute_fp(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=3):
    label = list(range(len(fps)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_documents(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("the of And É x1 wörd foo Bar baz qux".split()) + str(rng.randrange(30)) for _ in range(400)) for _ in range(6)]
    texts = [None, "", " \t\n", "one", "One two", "one two three", "a b c d e", "İ K x y"]
    for b in base:
        for _ in range(6):
            w = b.split(" ")
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    texts += texts[:12] + ["long " * 70_000]
    rows = [(i * 3 + 1, t, "a", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.near_duplicates(spark, docs, 3, 3).collect()}
    fps = [brute_fp(t, 3) for t in texts]
    comp = brute_components(fps)
    assert got == {r[0]: (f"{f:016x}", rows[c][0]) for r, f, c in zip(rows, fps, comp)}
    assert len(set(comp)) < len(set(fps))


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "x y z"), (7, "x y z"), (7, "x y z"), (None, "alone here")]
    got = S.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), 3, 3).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(7, 7), (7, 7)]
    assert sorted(str(r["component_id"]) for r in got if r["doc_id"] is None) == ["7", "None"]
    assert S.near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_equal_brute_force(spark, radius):
    rng = random.Random(radius)
    centers = [rng.getrandbits(64) for _ in range(8)]
    fps = set()
    for c in centers:
        for _ in range(25):
            x = c
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = S.fingerprint_links(spark, spark.createDataFrame([(s,) for s in signed], "fp long"), radius)
    roots = {r["node"]: r["root"] for r in connected_components(spark, links).collect()}
    mine = [roots.get(s, s) for s in signed]
    comp = brute_components(fps, radius)
    assert len(set(zip(mine, comp))) == len(set(mine)) == len(set(comp))


@pytest.mark.parametrize("radius", [2, 3])
def test_large_group(radius):
    rng = random.Random(9)
    fps = sorted({rng.getrandbits(14) | (rng.getrandbits(3) << 40) for _ in range(300)})
    u, v = S._large_group(np.array(fps, np.uint64), radius)
    assert all(int(a ^ b).bit_count() <= radius for a, b in zip(u, v))
    at = {f: i for i, f in enumerate(fps)}
    label = list(range(len(fps)))
    find = lambda i: i if label[i] == i else find(label[i])
    for a, b in zip(u.tolist(), v.tolist()):
        x, y = find(at[a]), find(at[b])
        label[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute_components(fps, radius)


def test_long_texts_are_cut_in_pieces(monkeypatch):
    rng = random.Random(4)
    texts = [b" ".join(b"w%d" % rng.randrange(50) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 400)] + [b"\n x" * 90, b"y" * 300, b"  " + b"ab " * 100 + b"   "]
    whole = [[S.shingles(t, k).tolist() for t in texts] for k in (1, 3, 5)]
    monkeypatch.setattr(S, "CHUNK_BYTES", 7)
    assert [[S.shingles(t, k).tolist() for t in texts] for k in (1, 3, 5)] == whole
