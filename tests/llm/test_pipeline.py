import zlib

import pytest

pytest.importorskip("lumenfold.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

import numpy as np  # noqa: E402

from lumenfold.llm import decontaminate, quality, shared  # noqa: E402
from lumenfold.llm.queries import END_ID, MIX_BLOCK, WEIGHTS, table, tokenizer_path  # noqa: E402
from tests.llm.test_minhash_dedup import brute as brute_components  # noqa: E402
from tests.llm.test_mixing import brute as brute_mix  # noqa: E402

DATA = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer

    docs = table(spark, DATA, "documents")
    rows = sorted((r["doc_id"], r["text"], r["source"]) for r in docs.collect())
    labels = table(spark, DATA, "labels")
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(spark, docs, labels).collect()}
    good = [r for r in rows if scores[r[0]]]
    first = brute_components([(r[0], r[1]) for r in good], corpus_pipeline.SIMILAR, corpus_pipeline.RADIUS)
    distinct = [r for r in good if first[r[0]] == r[0]]
    items = [(r["item_id"], r["text"]) for r in table(spark, DATA, "benchmark").collect()]
    index = decontaminate.Index(sorted(items))
    clean = [r for r in distinct if not index.search(r[1], decontaminate.LEAST_SCORE, decontaminate.LEAST_OVERLAP)]
    assert len(rows) > len(good) > len(distinct) > len(clean) > 100
    order = brute_mix([(i, s, t) for i, t, s in clean], WEIGHTS, MIX_BLOCK)
    tokenizer, start, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, _, text in order:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [END_ID]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in corpus_pipeline.run(spark, DATA).orderBy("start").collect()] == expected


def test_stages_keep_the_columns_and_take_empty_input(spark):
    docs = table(spark, DATA, "documents").limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if i + 1 == len(corpus_pipeline.STAGES):
            assert out.count() == 0
            break
        assert out.columns == docs.columns
        path = shared.new_path(spark, "test-stage")
        out.write.parquet(path)
        docs = spark.read.parquet(path)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_any_columns_and_rows(spark, stage):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use themselves."""
    texts = [r["text"] for r in table(spark, DATA, "documents").where("doc_id < 40").collect()]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(500, None, None, None, None), (None, "", "en", "src0", 0), (None, texts[0], "en", None, 5), rows[3], rows[3], (3, texts[4], "en", "src1", 1), (900, "long words here " * 20_000, "en", "src2", 9)]
    names = ["_gone_id", "_GONE_T", "gone_id", "gone_t", "_metadata", "_part", "_file", "_row", "sig", "fp", "component_id", "score", "slot", "block", "position", "part", "rank", "t", "k"]
    docs = spark.createDataFrame([(*r, *[7] * len(names)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    path = shared.new_path(spark, "test-names")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, DATA)
    got = out.collect()
    if stage == 4:
        assert len(got) == len(rows)
        return
    assert out.columns == docs.columns
    bag = [tuple(r)[:5] for r in got]
    assert all(bag.count(r) <= rows.count(r) for r in bag) and all(set(tuple(r)[5:]) == {7} for r in got)
    ids = [r[0] for r in bag]
    if stage == 1:  # rows that share the least id of their group stay, those without an id go if their group has one
        assert ids.count(3) >= 2 and bag.count(rows[3]) == rows.count(rows[3]) and (None, texts[0], "en", None, 5) not in bag
    if stage == 2:
        assert 500 in ids and 900 in ids
    if stage == 3:
        assert sorted(map(str, bag)) == sorted(map(str, rows))
