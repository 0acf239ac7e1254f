import hashlib
import os
import random
import re

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import exact_dedup as E  # noqa: E402


def best(i):
    return E.Best(b"", 0, i, i, 1)


@pytest.mark.parametrize("limit", [None, 200_000, 60_000])
def test_trie(tmp_path, limit):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40))) + bytes(rng.randrange(256) for _ in range(rng.randrange(3))) for _ in range(2000)]
    words += [b"", b"", words[0] + b"x", b"a" * 5000, b"a" * 5000, b"a" * 4999 + b"b"]
    rng.shuffle(words)
    trie = E.Trie(limit, str(tmp_path))
    for i, w in enumerate(words):
        trie.insert(w, best(i)._replace(digest=hashlib.sha256(w).digest()))
    got = list(trie.finish())
    want = {w: (min(i for i, x in enumerate(words) if x == w), words.count(w)) for w in set(words)}
    assert len(got) == len(want) and {w: (b.doc_id, b.n) for w, b in got} == want
    assert bool(os.listdir(tmp_path)) == bool(limit)  # both limits spill


def test_one_text_with_two_digests_is_an_error():
    trie = E.Trie()
    trie.insert(b"x", best(1))
    with pytest.raises(ValueError):
        trie.insert(b"x", best(2)._replace(digest=b"other"))


def expected(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for body, members in groups.items():
        keep = min(members)
        for m in members:
            out.append((rows[m[3]][0], None if keep[1] else keep[2], len(members), m == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("trie_bytes", [E.TRIE_BYTES, 40_000])
def test_owners(spark, trie_bytes):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "\t"), (4, "a b"), (5, "ab "), (6, "a  b"), (6, "a  b"), (7, "é x"), (8, "éx"), (None, "only"), (9, "long " * 200_000), (10, "long" * 200_000)]
    rows += [(100 + i, rng.choice(["one text", "one  text", f"text {rng.randrange(200)}"])) for i in range(2000)]
    docs = spark.createDataFrame([(i, t, 0, b"") for i, t in rows], "doc_id long, text string, row int, digest binary").repartition(7)
    got = sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in E.owners(spark, docs, trie_bytes=trie_bytes).collect()), key=str)
    assert got == expected(rows)


def test_drop_copies_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 7), (2, "a  b", 8), (2, "a  b", 8), (None, None, 9), (3, "", 1)], "doc_id long, text string, kept int")
    assert sorted(tuple(r) for r in E.drop_copies(spark, docs).collect()) == [(2, "a  b", 8), (3, "", 1)]
    assert E.owners(spark, docs.limit(0)).count() == 0 and E.drop_copies(spark, docs.limit(0)).count() == 0
