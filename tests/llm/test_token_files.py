import random
import zlib

import numpy as np
import pytest

pytest.importorskip("lumenfold.llm")
tokenizers = pytest.importorskip("tokenizers")

from lumenfold.llm import shared, token_files  # noqa: E402
from lumenfold.llm.queries import tokenizer_path  # noqa: E402


def brute(rows, end_id=2):
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, part int")
    path = shared.new_path(spark, "test-tokens")
    listed = token_files.write_token_files(spark, docs, path, tokenizer_path(), parts=parts)
    got = [tuple(r) for r in token_files.read_token_files(spark, path, listed).collect()]
    key = lambda r: (r[1], r[0] is not None)
    assert sorted(got, key=key) == sorted(brute([r[:2] for r in rows]), key=key)


def test_round_trip(spark):
    texts = ["plain words, and  spaces \n\n\t x", "", None, "it's <|endoftext|> inside", "a" * 5000, "日本語 テキスト 😀é\u00a0\u2003x", "\x1c\x1d a\x85b", "dup", "dup", " 'tis ''s  \n x\n"]
    check(spark, [(i * 7 - 3, t, "x", 1) for i, t in enumerate(texts)] + [(None, "null id", None, None), (4, "tie b", "", 0), (4, "tie a", "", 0), (4, "tie a", "", 0)])


def test_parts_grow_with_the_input_and_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 20_000)
    rng, counts = random.Random(8), []
    for n in (1000, 4000):
        rows = [(7, " ".join(rng.choices(["one", "two", "three", "四"], k=rng.randrange(1, 12))), "x", 1) for _ in range(n)] + [(6, None, "", 0), (8, "last", "", 0), (None, "b", "", 0)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, start string, part int")
        path = shared.new_path(spark, "test-tokens")
        listed = token_files.write_token_files(spark, docs, path, tokenizer_path())
        got = [tuple(r) for r in token_files.read_token_files(spark, path, listed).collect()]
        assert sorted(got, key=lambda r: r[1]) == brute([r[:2] for r in rows])
        assert max(p["n_docs"] for p in listed) < n / 2
        counts.append(len(listed))
    assert counts[1] > 2 * counts[0] > 4


def test_empty_table(spark):
    check(spark, [])


def test_pieces_equal_whole_encoding():
    rng = random.Random(5)
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    enc = token_files.Encoder(tokenizer_path(), None)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "1", "23", "é", "ß", "中", "!", "?!", "\u3000", "\u200b", "😀", "\r\n", "ñ", "_", "\u0301", "²", "Ⅷ", "\x1f", "\x00"]
    prose = ["word", "it's", "end.", "(a", "b)", "l'eau", "x1y", "ñ", "—", "''", "9", "don't", "\u0301z", "日本"]
    for _ in range(200):
        text = "".join(w + rng.choice("  \n") for w in rng.choices(prose, k=rng.randrange(1, 20))).strip()
        assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_encoded_as_one_text(monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "WORDS_A_TEXT", 7)
    rng = random.Random(6)
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    letters = "abcdefghijklmnopqrstuvwxyzABCéßñĠĊ中日ǅʰ́\U0001e900'9!²"
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(2000)]
    enc = token_files.Encoder(tokenizer_path(), None)
    want = [tok.encode(" " + w, add_special_tokens=False).ids for w in words]
    assert [np.frombuffer(b, "<u2").tolist() for b in enc._spaced_bytes(words)] == want
    text = " ".join(words)
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids
    # An added token that spans words: they are encoded one by one, and texts that hold it whole.
    tok.add_tokens([" of the", "cut"])
    path = str(tmp_path / "added.json")
    tok.save(path)
    enc = token_files.Encoder(path, None)
    some = ["end", "of", "the", "cutting", "word"]
    assert [np.frombuffer(b, enc.dtype).tolist() for b in enc._spaced_bytes(some)] == [tok.encode(" " + w, add_special_tokens=False).ids for w in some]
    assert np.frombuffer(enc.encode(["end of the word"])[0], enc.dtype).tolist() == tok.encode("end of the word", add_special_tokens=False).ids
