"""Vector index, set-similarity join and fixpoint on small frames, against brute force."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import set_similarity as S
from lumenfold.operators import vector_index as V
from lumenfold.operators.fixpoint import reach
from lumenfold.plans import similarity

DATA = "/root/testdata/sf0.01"


def brute_nearest(rows, ids, k):
    known = {i: v for i, v in rows if i is not None and v is not None}
    out = []
    for q in ids:
        likeness = sorted((-round(float(np.dot(np.float64(known[q]), np.float64(v))), 6), i) for i, v in known.items() if i != q)
        out += [(q, i, -s) for s, i in likeness[:k]]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK_ROWS", block)
    monkeypatch.setattr(V, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(60, 5)), 2).tolist()
    rows = [(i, p) for i, p in enumerate(points)] + [(100 + i, points[0]) for i in range(40)] + [(None, points[1]), (999, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = V.nearest(vectors, vectors.where("vec_id % 10 = 0"), 4)
    want = brute_nearest(rows, [i for i, _ in rows if i is not None and i % 10 == 0 and i != 999], 4)
    assert sorted((r["query_id"], r["id"], r["likeness"]) for r in got.collect()) == want
    assert V.nearest(vectors.limit(0), vectors.limit(0), 4).count() == 0


def test_index_finds_clusters_with_few_probes(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    points = centres[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 100 = 0")
    pairs = lambda df: {(r["query_id"], r["id"]) for r in df.collect()}
    exact, about = pairs(V.nearest(vectors, queries, 10)), pairs(V.nearest(vectors, queries, 10, 32, 3))
    assert len(exact) == 300 and len(exact & about) >= 0.9 * len(exact)
    assert len(V.fit_cells(vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 32, 100)) == 32


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similarity_join(spark, threshold):
    rng = random.Random(4)
    base = [[f"t{rng.randrange(400)}" for _ in range(rng.randrange(1, 40))] for _ in range(40)]
    rows = [(i, rng.choice(base) + [f"x{rng.randrange(50)}" for _ in range(rng.randrange(4))]) for i in range(300)]
    rows += [(1000, []), (1001, None), (None, base[0]), (5000, rows[7][1] * 2), (5001, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, words array<string>")
    joined = S.Join(spark, S.token_sets(docs, F.col("words"), "doc_id"), threshold)
    sets = {}
    for i, w in rows:
        if i is not None and w:
            sets.setdefault(frozenset(w), []).append(i)
    least = {min(ids): s for s, ids in sets.items()}
    want = {(a, b) for a in least for b in least if a < b and jaccard(least[a], least[b]) >= threshold}
    assert {(r["left_id"], r["right_id"]) for r in joined.links.collect()} == want
    links = {i: sum(i in p for p in want) for i in least}
    assert sorted(map(tuple, joined.by_document().collect())) == sorted((i, min(ids), links[min(ids)]) for ids in sets.values() for i in ids)


def test_few_pairs_are_compared(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    joined = S.Join(spark, S.token_sets(docs, S.shingles(F.col("text"), 5), "doc_id"), 0.8)
    n = joined.classes.count()
    assert joined.links.count() > 0 and joined.candidates.count() < 0.01 * n * (n - 1) / 2


def test_shingles(spark):
    texts = [(None,), ("",), (" \n",), ("a b",), ("a b\tc",), ("a b c d",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").coalesce(1).select(S.shingles(F.col("t"), 3)).collect()]
    assert got == [[], [], [], ["a b"], ["a b c"], ["a b c", "b c d"]]


def test_reach(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)] + [(1, 1), (None, 3), (3, None), (0, 7), (0, 7)]
    want, hops, step = {0: 0, 5: 0}, 0, {0, 5}
    while step:
        hops += 1
        step = {b for a, b in edges if a in step and b is not None} - want.keys()
        want |= dict.fromkeys(step, hops)
    frame = spark.createDataFrame(edges, "src long, dst long")
    seeds = spark.createDataFrame([(0,), (5,), (5,), (None,)], "node long")
    assert {r["node"]: r["hops"] for r in reach(spark, frame, seeds).collect()} == want
    assert {r["node"]: r["hops"] for r in reach(spark, frame, seeds, 1).collect()} == {k: v for k, v in want.items() if v <= 1}
    assert reach(spark, frame, seeds.limit(0)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edges_")]


def test_runs_of_words(spark):
    lists = [[3], [], [1, 2], [1, 2, 3], [1, 2, 3, 1, 2, 3], [2, 1, 3], [1, 2]]
    values, n = S.token_runs(np.array(sum(lists, []), np.int64), np.array([len(x) for x in lists]), 3)
    assert n.tolist() == [1, 0, 1, 1, 4, 1, 1]
    runs = [tuple(x[i : i + 3]) for x in lists if x for i in range(max(1, len(x) - 2))]
    assert len(set(zip(runs, values.tolist()))) == len(set(runs)) == len(set(values.tolist()))
    texts = [(0, "a b c d e f"), (1, "a b c d e  f\ta b c d e"), (2, "b"), (3, " b"), (4, "b b"), (5, " "), (6, None)]
    docs = spark.createDataFrame(texts, "id long, text string")
    by_words = S.Join(spark, S.token_sets(docs, S.split(F.col("text")), "id"), 0.2, 5)
    by_shingles = S.Join(spark, S.token_sets(docs, S.shingles(F.col("text"), 5), "id"), 0.2)
    for a, b in ((by_words.links, by_shingles.links), (by_words.by_document(), by_shingles.by_document())):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) != []


def test_sketches_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(5)
    for size in (1, 3, 64, 65, 700, 3000):
        for kept in (0.0, 0.5, 0.8, 0.95, 1.0):
            x = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
            y = np.unique(np.append(x[: int(kept * size)], rng.integers(-(2**63), 2**63 - 1, int(1.2 * size) - int(kept * size))))
            n = np.array([len(x), len(y)])
            near = S.Sketched(np.array([7, 9]), n, S.sketches(np.append(x, y), n), 0.8).near(np.array([7]), np.array([9]))[0]
            shared = len(np.intersect1d(x, y))
            assert near or shared < 0.8 * (len(x) + len(y) - shared)
            assert not near or size < 64 or kept > 0.5


def test_packed_rows():
    ids = np.array([5, 5, -(2**62), 2**63 - 1, -(2**63), 0], np.int64)
    assert [c.tolist() for c in S.unpacked(S.packed(id=ids, n=ids[::-1]))] == [ids.tolist(), ids[::-1].tolist()]
    got = {part: [c.tolist() for c in S.unpacked(blob)] for part, blob in S.dealt(np.array([2, 0, 2]), id=ids[:3], n=np.arange(3))}
    assert got == {0: [[5], [1]], 2: [[5, -(2**62)], [0, 2]]}


def test_pairs_that_meet_a_few_at_a_time(monkeypatch):
    rng = random.Random(2)
    sets = {i: frozenset(rng.sample(range(60), rng.randrange(1, 30))) for i in range(100)}
    sets |= {i + 100: sets[i] | {rng.randrange(60)} for i in range(100)}
    rows = [(i, len(s), at + 1, t) for i, s in sets.items() for at, t in enumerate(sorted(s)[: len(s) - int(np.ceil(0.8 * len(s) - 1e-9)) + 1])]
    columns = [np.array(c, np.int64) for c in zip(*rows)]
    want = {(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8}
    got = {}
    for most in (1 << 19, 50, 1):
        monkeypatch.setattr(S, "AT_ONCE", most)
        got[most] = {p for a, b in S.pairs_that_meet(*columns, 0.8) for p in zip(a.tolist(), b.tolist())}
        assert want <= got[most] and got[most] == got[1 << 19]


def test_many_buckets_and_blocks(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"t{i}" for i in range(60)]
    rows = [(i * 97 - 4000, [w if rng.random() > 0.06 else f"x{rng.randrange(1000)}" for w in base]) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, words array<string>")
    least = {}
    for i, w in rows:
        least.setdefault(frozenset(w), i)
    want = sorted((a, b) for x, a in least.items() for y, b in least.items() if a < b and jaccard(x, y) >= 0.8)
    assert len(want) > 1000
    for entries, size, ids in ((1 << 20, 32 << 20, 1000), (200, 4096, 10)):
        monkeypatch.setattr(S, "ENTRIES", entries)
        monkeypatch.setattr(S, "SKETCH_BYTES", size)
        monkeypatch.setattr(S, "BLOCK_BYTES", size)
        monkeypatch.setattr(S, "SENT", ids)
        joined = S.Join(spark, S.token_sets(docs, F.col("words"), "id"), 0.8)
        assert sorted((r["left_id"], r["right_id"]) for r in joined.links.collect()) == want


def test_sets_that_only_meet_are_not_sent_whole(spark):
    """Fours that share 75 of 99 tokens: pairs that the filters leave, and no links but the planted one."""
    rows = [(i, [f"t{i // 4}-{k}" for k in range(75)] + [f"u{i}-{k}" for k in range(24)]) for i in range(200)]
    rows.append((200, rows[0][1] + ["more"]))
    joined = S.Join(spark, S.token_sets(spark.createDataFrame(rows, "id long, words array<string>"), F.col("words"), "id"), 0.8)
    assert [(r["left_id"], r["right_id"]) for r in joined.links.collect()] == [(0, 200)] and joined.candidates.count() < 50


def test_disk_is_less_than_twice_the_documents(spark):
    """What is shuffled and stored, for a table of 15.5 MB; whole sets have 31 MB."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()

    def shuffled():
        stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = shuffled().keys()
    joined = similarity.similar(spark, "/root/testdata/sf0.1")
    sent = sum(v for k, v in shuffled().items() if k not in before)
    files = [f for df in (joined.classes, joined.members, joined.candidates, joined.links) for f in df.inputFiles()]
    kept = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert joined.links.count() > 40 and sent > 1e6
    assert sent + kept < 2 * os.path.getsize("/root/testdata/sf0.1/documents.parquet")
