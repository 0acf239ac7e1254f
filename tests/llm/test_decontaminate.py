import itertools
import math
import pickle
import random
import time
import tracemalloc
from collections import Counter

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import decontaminate as D  # noqa: E402


def brute(docs, items, least=D.LEAST_SCORE, overlap=D.LEAST_OVERLAP, k=D.WORDS):
    kept = [(i, D.words_of(t)) for i, t in items if D.words_of(t)]
    df = Counter(t for _, w in kept for t in set(w))
    mean, longest = sum(len(w) for _, w in kept) / len(kept), max(len(w) for _, w in kept)
    out = {}
    for d, text in docs:
        words = D.words_of(text)
        for s in range(0, max(1, len(words) - longest), longest) if words else ():
            passage = words[s : s + 2 * longest]
            for i, w in kept:
                c = Counter(w)
                weight = {t: math.log(1 + (len(kept) - df[t] + 0.5) / (df[t] + 0.5)) * f * (D.K1 + 1) / (f + D.K1 * (1 - D.B + D.B * len(w) / mean)) for t, f in c.items()}
                score = sum(x for t, x in weight.items() if t in set(passage)) / sum(weight.values())
                if score < least - 1e-9:
                    continue
                share = lambda part: len(D.shingles(part, k) & D.shingles(passage, min(k, len(part)))) / len(D.shingles(part, k))
                known = lambda part: len(set(part) & set(passage)) / len(set(part))
                cut = len(w) - max(D.ANSWER_WORDS, len(w) // 4)
                q, a = (share(w[:cut]), known(w[cut:])) if cut >= k else (share(w), known(w))
                if share(w) >= overlap and q >= D.LEAST_QUESTION and a >= D.LEAST_ANSWER:
                    out[d, i] = max(out.get((d, i), (0,) * 4), (round(score, 9), share(w), q, a))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 30
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(3, 40))) for i in range(30)] + [(99, None), (98, ""), (97, "Same, text É here now and"), (96, "same text é here now AND")]
    docs = []
    for d in range(60):
        w = text(rng.randrange(0, 250)).split()
        for _ in range(rng.randrange(3)):
            item = D.words_of(rng.choice(items)[1])
            if item and rng.random() < 0.5:
                item[rng.randrange(len(item))] = "edited"
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
        docs.append((d, " ".join(w)))
    docs += [(100, None), (101, ""), (102, "SAME text, é here now and!"), (103, "pad " * 30_000 + items[3][1])]
    frame = spark.createDataFrame([(*r, 1.0, 2) for r in docs], "doc_id long, text string, score double, item_id int")
    got = {(r["doc_id"], r["item_id"]): (round(r["score"], 9), r["overlap"], r["question_overlap"], r["answer_overlap"]) for r in D.contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    expected = brute(docs, items)
    assert len(expected) > 20 and got == expected
    kept = D.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in expected}


def random_case(seed, n_items=60, words=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["the"] * 30
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i if i % 7 else None, text(rng.randrange(3, 40))) for i in range(n_items)]
    docs = [(d, " ".join([text(rng.randrange(80)), *(rng.choice(items)[1] for _ in range(rng.randrange(3))), text(20)])) for d in range(60)]
    return items, docs


@pytest.mark.parametrize("shards", [3, 10])
def test_shards_change_no_score(spark, monkeypatch, shards):
    items, docs = random_case(shards)
    items, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    rows = lambda: sorted(map(tuple, D.contaminated(docs, items, 0.2, 0.1).collect()), key=str)
    whole, kept = rows(), {r["doc_id"] for r in D.drop_contaminated(docs, items).collect()}
    size = items.selectExpr("sum(octet_length(text))").first()[0]
    monkeypatch.setattr(D, "INDEX_BYTES", -(-size // shards))
    assert len(list(D.index_shards(items, D.WORDS, "item_id", "text"))) == shards
    assert len(whole) > 100 and rows() == whole
    assert {r["doc_id"] for r in D.drop_contaminated(docs, items).collect()} == kept


def test_blocks_and_steps_change_nothing(monkeypatch):
    items, docs = random_case(3, 300, 3000)
    items = [(i, t) for i, (_, t) in enumerate(items)]
    index = D.Index(items)
    whole = [index.search(t, 0.3, 0.1) for _, t in docs]
    assert sum(map(len, whole)) > 50
    assert index.work["blocks"] < index.work["passages"] * index.blocks and index.work["items"] < index.work["passages"] * len(items)
    monkeypatch.setattr(D, "STEP", 2)
    monkeypatch.setattr(D, "CELLS", 50)
    monkeypatch.setattr(D, "CHUNK_CHARS", 300)
    assert [index.search(t, 0.3, 0.1) for _, t in docs] == whole
    mixed = [t for _, t in docs[:9]] + [None, "", "..."] + [t for _, t in docs[9:]]
    assert list(index.search_all(mixed, 0.3, 0.1)) == [*whole[:9], {}, {}, {}, *whole[9:]]
    monkeypatch.setattr(D, "GROUP_CHARS", 900)
    assert list(index.search_all(mixed, 0.3, 0.1)) == [*whole[:9], {}, {}, {}, *whole[9:]]
    monkeypatch.setattr(D, "BLOCK", 3)
    index = D.Index(items)
    found = [{index.ids[i]: r for i, r in index.search(t, 0.3, 0.1).items()} for _, t in docs]
    assert found == whole


def zipf_case(n_items, n_words=20_000, vocabulary=18_000):
    """Items of 20 words, and a text, that share a vocabulary with some very frequent words; the text holds 20 items."""
    rng = random.Random(n_items)
    words, weights = [f"w{i}" for i in range(vocabulary)], list(itertools.accumulate(1 / (i + 1) for i in range(vocabulary)))
    items = [(i, " ".join(rng.choices(words, cum_weights=weights, k=20))) for i in range(n_items)]
    planted = rng.sample(range(n_items), 20)
    text = [x for i in planted for x in [*rng.choices(words, cum_weights=weights, k=n_words // 20), items[i][1]]]
    return items, " ".join(text), set(planted)


def test_long_lists_are_jumped_over():
    """Work grows much less than the number of items, and most postings of the passages' words are never read."""
    took, scored = [], []
    for n in (3_000, 30_000):
        items, text, planted = zipf_case(n)
        index = D.Index(items)
        index.live_blocks(D.LEAST_SCORE)
        at = time.process_time()
        found = index.search(text, D.LEAST_SCORE, D.LEAST_OVERLAP)
        took.append(time.process_time() - at)
        scored.append(index.work["items"])
        assert planted <= {index.ids[i] for i in found}
        assert index.work["blocks"] * D.BLOCK < 0.2 * index.work["postings"], index.work
    assert scored[1] < 0.02 * index.work["passages"] * len(items) and took[1] < 6 * took[0] + 0.5


def test_the_index_is_compact():
    """A full shard's index takes less than 400 MB."""
    items, *_ = zipf_case(8_000, vocabulary=24_000)
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(D.Index(items))) * (D.INDEX_BYTES / size) < 400 << 20
    tracemalloc.start()
    index = D.Index(items)
    index.live_blocks(D.LEAST_SCORE)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held * (D.INDEX_BYTES / size) < 400 << 20


def test_a_very_long_text_takes_bounded_memory(monkeypatch):
    items = [(i, " ".join(f"w{(i * 31 + j * 7) % 5000}" for j in range(20))) for i in range(2000)]
    index = D.Index(items)
    monkeypatch.setattr(D, "CHUNK_CHARS", 1 << 16)
    text = " ".join([f"w{i % 5000} other{i % 90} the" for i in range(60_000)] + [items[77][1]])
    tracemalloc.start()
    found = index.search(text, D.LEAST_SCORE, D.LEAST_OVERLAP)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 77 in {index.ids[i] for i in found} and peak < 40 << 20


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_recall_of_edited_items(edits):
    """Items of the test data, with words changed, among 100 words of a document."""
    import pyarrow.parquet as pq

    data = "/root/testdata/sf0.1"
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{data}/benchmark.parquet").to_pylist()]
    texts = [w for w in (D.words_of(t) for t in pq.read_table(f"{data}/documents.parquet", columns=["text"]).column(0).to_pylist()[:600]) if len(w) > 150]
    index, rng, found = D.Index(items), random.Random(edits), 0
    for i, text in items:
        words = D.words_of(text)
        for at in rng.sample(range(len(words)), edits):
            words[at] = f"changed{rng.randrange(1000)}"
        around = rng.choice(texts)
        at = rng.randrange(len(around) - 100)
        hit = index.search(" ".join([*around[at : at + 50], *words, *around[at + 50 : at + 100]]), D.LEAST_SCORE, D.LEAST_OVERLAP)
        found += i in {index.ids[x] for x in hit}
    assert found >= 0.99 * len(items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f"), (None, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == 1
    assert {r["item_id"] for r in D.contaminated(docs, items).collect()} == {1, None}
