import hashlib
import random

import pytest

pytest.importorskip("lumenfold.llm")

import numpy as np  # noqa: E402

from lumenfold.llm import suffix_dedup as S  # noqa: E402


def brute(rows, length):
    """Spans by a dictionary of all strings."""
    seen, gone = {}, {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            if seen.setdefault(data[p : p + length], (i, p)) != (i, p):
                gone.setdefault(i, set()).update(range(p, p + length))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        cut = [p in gone.get(i, ()) for p in range(len(data))]
        kept = bytes(b for b, c in zip(data, cut) if not c)
        spans = sum(c and not (p and cut[p - 1]) for p, c in enumerate(cut))
        out.append((i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def samples(rng):
    word = lambda: rng.choice(["the", "of", "é", "naïve", "zyx"]) + str(rng.randrange(25))
    passage = [" ".join(word() for _ in range(rng.randrange(4, 20))) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [rng.choice(passage) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randrange(1, 15))) for _ in range(rng.randrange(1, 6))]
        rows.append((i * 3 - 20, " ".join(parts)))
    rows += [(500 + i, rows[5][1]) for i in range(4)]
    rows += [(600, "ab" * 200), (601, "a" * 333), (602, "xyz" * 60 + "a" * 90), (603, None), (604, ""), (605, "short"), (606, "\x00" * 70), (None, rows[7][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length,shard_bytes,hot_least", [(40, 1 << 20, 64), (100, 1 << 20, 64), (30, 400, 64), (40, 1 << 20, 2), (100, 500, 3)])
def test_equals_brute_force(spark, length, shard_bytes, hot_least, monkeypatch):
    monkeypatch.setattr(S, "HOT_LEAST", hot_least)
    rows = samples(random.Random(length))
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, k int, spans string").repartition(5)
    got = [tuple(r)[:5] for r in S.remove_repeats(spark, docs, length, shard_bytes).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, length), key=str)


def test_long_texts_and_repeated_rows(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    rows = [(1, text + text[100:9000]), (2, text[5000:]), (2, text[5000:]), (3, "q" + text[:150] + "r")]
    got = [tuple(r)[:5] for r in S.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), 100).collect()]
    assert sorted(got) == sorted(brute(rows, 100))


def test_empty_table(spark):
    assert S.remove_repeats(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("held, sent", [(1, 1), (1500, 200), (32 << 20, 4 << 20)])
def test_pieces_of_a_long_text(monkeypatch, held, sent):
    import pyarrow as pa

    monkeypatch.setattr(S, "BLOCK_BYTES", 500)
    monkeypatch.setattr(S, "HELD_BYTES", held)
    monkeypatch.setattr(S, "SENT_BYTES", sent)
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(4000))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([text, text[300:3000]])], ["k", "text"])
    out = [b for b in S._gather(100, 1 << 20)(S._scatter(100, 3, np.zeros(0, np.uint64))(iter([batch])))]
    spans = np.concatenate([b.column(1).flatten().to_numpy().reshape(-1, 2) for b in out])
    docs = np.concatenate([np.repeat(b.column(0).to_numpy(), b.column(1).value_lengths().to_numpy() // 2) for b in out])
    d, a, b = S.to_spans(docs, spans[:, 0], spans[:, 1])
    assert (d.tolist(), a.tolist(), b.tolist()) == ([8], [0], [2700])


def test_planes_of_extreme_values():
    ids = np.array([S.LEAST, (1 << 63) - 1, -(1 << 63), 0, 5, 5], np.int64)
    back = np.cumsum(S._from_planes(S._planes(np.diff(ids, prepend=np.int64(0))).ravel(), np.int64))
    assert back.tolist() == ids.tolist()


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab" if seed % 2 else "abcd") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 12))]
    parts += parts[:3]
    text = np.frombuffer("".join(parts).encode(), np.uint8)
    size = np.array([len(p) for p in parts])
    stops = np.repeat(np.cumsum(size), size)
    suffix = lambda i: bytes(text[i : stops[i]])
    order = S.suffix_array(text, stops)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: (suffix(i), i))

    def prefix(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    expected = [0] + [prefix(suffix(a), suffix(b)) for a, b in zip(order, order[1:])]
    assert S.common_prefixes(text, stops, order).tolist() == expected


def test_common_passage_is_spread(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(30))
    rows = [(i, " ".join([*(word() for _ in range(8)), passage, *(word() for _ in range(8))])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.select(docs["doc_id"].alias("k"), "text")
    assert len(S.hot_keys(keyed, 100, 300 * 300, 4))
    got = [tuple(r)[:5] for r in S.remove_repeats(spark, docs, 100).collect()]
    assert sorted(got) == sorted(brute(rows, 100))
