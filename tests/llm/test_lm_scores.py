import math
import random
from collections import Counter

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import lm_scores as M  # noqa: E402


def brute(rows, target, beta=M.BETA):
    words = lambda t: [w.lower() for w in (t or "").encode().split()]
    docs = [(i, list(zip([None, *words(t)[:-1]], words(t)))) for i, t in rows]
    vocabulary = len({w for _, d in docs for _, w in d})
    grams = [(i, (Counter(d), Counter(v for v, _ in d))) for i, d in docs]
    every, aim = (Counter(), Counter()), (Counter(), Counter())
    for i, g in grams:
        for k in (0, 1):
            every[k].update(g[k])
            if i in target:
                aim[k].update(g[k])
    scale = sum(aim[1].values()) / max(1, sum(every[1].values()))
    sums = {}
    for i, g in grams:  # each row is taken out of the models by itself
        loss = lambda counts, by, own: sum(c * math.log(by * (counts[1][v] - own * c) + beta * vocabulary) for v, c in g[1].items()) - sum(c * math.log(by * (counts[0][p] - own * c) + beta) for p, c in g[0].items())  # noqa: E731, B023
        row = (sum(g[1].values()), loss(aim, 1, i in target), loss(every, scale, 1))
        sums[i] = tuple(map(sum, zip(sums.get(i, (0, 0, 0)), row)))
    return {i: (n, t / max(1, n), b / max(1, n), (b - t) / max(1, n) if scale else 0.0) for i, (n, t, b) in sums.items()}


@pytest.mark.parametrize("target,hot", [({1, 2, 3, 5, 8, 13, 999}, False), ({1, 2, 3, 5, 8, 13, 999}, True), (set(), True)])
def test_equals_brute_force(spark, target, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(M, "HOT_ENTRIES", 10)
        monkeypatch.setattr(M, "HOT_LEAST", 10)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["The", "the", "of", "É", "x\ty", "\n"]) + str(rng.randrange(9)) for _ in range(rng.randrange(50)))) for i in range(80)]
    rows += [(None, "a b"), (None, "c d"), (200, None), (201, ""), (202, " \n"), (5, "same id again"), (203, "w " * 100_000)]
    docs = spark.createDataFrame([(*r, True, 1.0) for r in rows], "doc_id long, text string, is_target boolean, score double")
    ids = spark.createDataFrame([(t,) for t in [*target, *target]], "doc_id long")
    got = {r["doc_id"]: tuple(r)[1:] for r in M.cross_entropy_difference(spark, docs, ids).collect()}
    expected = brute(rows, target)
    assert got.keys() == expected.keys()
    for i, e in expected.items():
        assert got[i] == pytest.approx(e, abs=1e-9), i


def test_empty_table(spark):
    assert M.cross_entropy_difference(spark, spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1,)], "doc_id long")).count() == 0
