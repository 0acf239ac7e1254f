import random

import pytest

pytest.importorskip("lumenfold.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from lumenfold.llm import minhash_dedup as M  # noqa: E402
from tests.llm.test_simhash_dedup import brute_fp  # noqa: E402


def shingle_set(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, least=0.8, radius=None):
    """Component ids of documents, those without words only if a radius for fingerprints is given."""
    sets = [shingle_set(t) for _, t in rows]
    fps = [brute_fp(t, 5) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if label[i] == label[j]:
                continue
            if a and b and len(a & b) >= least * len(a | b) or radius is not None and (fps[i] ^ fps[j]).bit_count() <= radius:
                x, y = label[i], label[j]
                label = [min(x, y) if z in (x, y) else z for z in label]
    return {r[0]: min(q[0] for q, m in zip(rows, label) if m == k) for r, k, s in zip(rows, label, sets) if s or radius is not None}


def planted(seed, bases=40, copies=4):
    """Base texts and copies with edits that leave similarities of 0.6 to 1."""
    rng, rows = random.Random(seed), []
    for _ in range(bases):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 400))]
        rows.append(" ".join(base))
        for _ in range(copies):
            w = list(base)
            for at in rng.sample(range(len(w)), rng.randrange(1, max(2, len(w) // 22))):
                w[at] = f"e{rng.randrange(5000)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


def test_equals_brute_force_on_planted_edits(spark):
    rows = planted(1)
    rows += [(900 + i, t) for i, t in enumerate(["", None, " \n", "One", "one ", "a b c d e", "A  b c d e", rows[0][1].upper(), "z " * 30_000])]
    got = M.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)


def test_chains_and_a_large_group(spark):
    rng = random.Random(5)
    chain, base = [[f"c{i}" for i in range(200)]], [f"b{i}" for i in range(200)]
    for i in range(30):  # each is like the one before and unlike the first
        chain.append([*chain[-1]])
        chain[-1][i * 6] = f"x{i}"
    group = [[f"y{rng.randrange(999)}" if rng.random() < 0.02 else w for w in base] for _ in range(150)]
    rows = [(i, " ".join(w)) for i, w in enumerate([*chain, *group])]
    got = M.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert M.near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "x y z"), (7, "x y z"), (7, "X y z"), (7, "x y z"), (None, "alone here")]
    got = M.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(tuple(r)) for r in got) == ["(7, 7)"] * 3 + ["(None, 7)", "(None, None)"]


def test_keep_one(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    edits = []
    for n in range(6):
        w = list(base)
        for _ in range(n):
            w[rng.randrange(len(w))] = f"new{n}"
        edits.append(" ".join(w))
    texts = [*edits, "alone " + " ".join(f"z{i}" for i in range(80)), None, "", "\n"]
    assert [r["doc_id"] for r in M.keep_one(spark, spark.createDataFrame([(None, "x y"), (M.LEAST_ID, "X y"), (M.LEAST_ID, "x y")], "doc_id long, text string")).collect()] == [M.LEAST_ID] * 2
    rows = list(enumerate(texts)) + [(50, "a word"), (50, "another text"), (50, "another text"), (60, "A  word")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows] + [(None, texts[0], 2, "y"), (None, "no copy", 2, "y")], "doc_id long, text string, fp int, t string")
    kept = M.keep_one(spark, docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(0, texts[0]), (6, texts[6]), (7, None), (50, "a word"), (50, "another text"), (50, "another text"), (None, "no copy")], key=str)


def test_the_pipeline_keeps_one_of_each_similar_group(spark):
    rows = planted(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, "").collect()}
    assert kept == set(brute(rows, corpus_pipeline.SIMILAR, corpus_pipeline.RADIUS).values())


def test_recall_of_planted_edits_near_the_threshold(spark):
    """Pairs of texts with a similarity of 0.80 to 0.85, each unlike all others."""
    rng, rows = random.Random(21), []
    while len(rows) < 600:
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(150, 400))]
        w = list(base)
        for at in rng.sample(range(len(w)), max(1, len(w) // 46)):
            w[at] = f"e{rng.randrange(10**6)}"
        a, b = shingle_set(" ".join(base)), shingle_set(" ".join(w))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sum(r["component_id"] < r["doc_id"] for r in M.near_duplicates(spark, docs, radius=3).collect())
    assert found == 300


def test_recall_in_a_family_of_texts_below_the_threshold(spark):
    """All texts come of one base and are 0.45 to 0.8 alike, so bands have many members in different components;
    each has one partner at 0.80 to 0.83."""
    rng, rows = random.Random(3), []
    base = [f"w{i}" for i in range(300)]

    def edited(words, n):
        return [f"e{rng.randrange(10**9)}" if at in places else w for places in [set(rng.sample(range(len(words)), n))] for at, w in enumerate(words)]

    while len(rows) < 400:
        x = edited(base, 5)
        y = edited(x, 6)
        a, b = shingle_set(" ".join(x)), shingle_set(" ".join(y))
        if 0.8 <= len(a & b) / len(a | b) < 0.83:
            rows += [(len(rows), " ".join(x)), (len(rows) + 1, " ".join(y))]
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = brute(rows)
    assert len(set(expected.values())) > 150  # not one large component
    assert sum(got[i] == got[c] for i, c in expected.items()) >= 0.98 * len(rows)
    assert all(expected[i] == expected[c] for i, c in got.items())
