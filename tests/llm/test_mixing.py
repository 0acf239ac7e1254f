import random

import pytest

pytest.importorskip("lumenfold.llm")

from pyspark.sql import functions as F  # noqa: E402

from lumenfold.llm import mixing as M  # noqa: E402


def brute(rows, weights, block):
    """Earliest deadline first, slot by slot, over whole documents."""
    by = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, r[2] or "")):
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, s or ""))
    w = {s: weights.get(s, 1) for s in names}
    total, done, order = sum(w.values()), dict.fromkeys(names, 0), []
    slot = 0
    while any(done[s] * block < len(by[s]) for s in names):
        ready = [(-(-(done[s] + 1) * total // w[s]), -w[s], k) for k, s in enumerate(names) if done[s] * total // w[s] <= slot]
        s = names[min(ready)[2]]
        order += by[s][done[s] * block : (done[s] + 1) * block]
        done[s] += 1
        slot += 1
        for x in names if len(names) < 50 else ():  # never a whole block from its share
            assert abs(done[x] - slot * w[x] / total) < 1
    return order


@pytest.mark.parametrize("block", [1, 3])
def test_order(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice([i * 997, -i]), rng.choice(["a", "a", "a", "b", "c", None, "", "d"]), rng.choice([None, "", "t", "u"])) for i in range(400)] + [(None, "a", "x"), (None, "b", None), (5000, "b", "z"), (5000, "b", "y")]
    weights = {"a": 5, "b": 2, None: 3}
    names = ["doc_id", "source", "text", "slot", "lang", "_row", "_source", "_rank", "Block"]
    docs = spark.createDataFrame([(*r, 7, "kept", "x", 5, None, 1.5) for r in rows], "doc_id long, source string, text string, slot int, lang string, _row string, _source int, _rank string, Block double")
    out = M.mix(docs, weights, block)
    got = out.orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert [(r["doc_id"], r["source"], r["text"]) for r in got] == brute(rows, weights, block)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got) and got[0]["lang"] == "kept"
    assert {(r["_row"], r["_source"], r["_rank"]) for r in got} == {("x", 5, None)}
    plain = M.interleave(docs, weights, block)
    assert plain.columns == names
    assert [tuple(r) for r in plain.collect()] == [(*r, 7, "kept", "x", 5, None, 1.5) for r in brute(rows, weights, block)]


def _check(spark, rows, weights, block):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.mix(docs, weights, block).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert [(r["doc_id"], r["source"], r["text"]) for r in got] == brute(rows, weights, block)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)


def test_many_sources(spark):
    rng = random.Random(9)
    rows = [(i, f"host{rng.randrange(3000)}.example", "t") for i in range(6000)] + [(i, "big", "u") for i in range(6000, 7000)]
    _check(spark, rows, {"big": 40, "host7.example": 3}, 4)
    _check(spark, rows[:3000], {}, 2)


def test_many_slots_in_pages(spark):
    rows = [(i, "a" if i % 3 else "b", "t") for i in range(900)] + [(i, "c", "t") for i in range(900, 930)]
    _check(spark, rows, {"a": 9000, "b": 1500}, 1)


def test_pages_do_not_change_the_cycle(spark):
    classes = [(1, 7), (3, 2), (5, 4)]
    whole = sorted(map(tuple, M.schedule(spark, classes, 1000).collect()))
    assert len(whole) == 33 and sorted(map(tuple, M.schedule(spark, classes, 5).collect())) == whole


def test_hashed_ids_and_one_id_repeated(spark):
    rng = random.Random(3)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.choice("ab"), "t") for _ in range(3000)] + [(12, "a", f"v{i % 50}") for i in range(4000)]
    rows += [(i, "b", "dense") for i in range(3000)] + [((1 << 63) - 1, "a", "z"), (-(1 << 63), "a", "z")]
    _check(spark, rows, {"a": 2}, 16)


def test_running_sums(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice([rng.randrange(300), rng.randrange(1 << 40), rng.randrange(1 << 62)]), rng.randrange(9)) for _ in range(500)})
    rows = list(dict(rows).items())
    got = {r["k"]: r["_start"] for r in M.running_sums(spark.createDataFrame(rows, "k long, n long"), "k", "n").collect()}
    total, expected = 0, {}
    for k, n in sorted(rows):
        expected[k] = total
        total += n
    assert got == expected


def test_empty_and_bad(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.mix(docs, {"a": 2}).count() == 0 and M.interleave(docs, {"a": 2}).count() == 0
    with pytest.raises(ValueError):
        M.mix(docs, {"a": 0}).count()
    nulls = spark.range(5).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("text"))
    assert sorted(r["position"] for r in M.mix(nulls).collect()) == [0, 1, 2, 3, 4]
