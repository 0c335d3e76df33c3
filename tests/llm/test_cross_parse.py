"""Operator 10 against naive parsing, and held-out accuracy."""

import random
import tracemalloc

import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import cross_parse


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(1)
    data = bytes(rng.choice(b"abc") for _ in range(60))
    moves = cross_parse.suffix_automaton(data, 128)

    def accepts(text):
        state = 0
        for byte in text:
            state = moves[state][byte]
            if state < 0:
                return False
        return True

    for _ in range(3000):
        text = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 9)))
        assert accepts(text) == (text in data)
    assert len(moves) < 2 * len(data)


def naive(text, samples):
    phrases, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and any(text[i : i + n + 1] in s for s in samples):
            n += 1
        phrases, i = phrases + 1, i + n
    return phrases


def test_phrases_equal_naive_parsing():
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    samples = (("x", tuple(" ".join(word("abcd") for _ in range(40)).encode() for _ in range(3))), ("y", (" ".join(word("cdef") for _ in range(80)).encode(),)))
    parser = cross_parse.Parser(samples)
    texts = [" ".join(word("abcdef") for _ in range(rng.randint(0, 60))).encode()[: cross_parse.LANE] for _ in range(50)] + [b""]
    got = parser.phrases(texts)
    for text, counts in zip(texts, got):
        assert list(counts) == [naive(text, s) for _, s in samples]


def test_folding():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aBz9 .\n\tÄé\u00a0\u0085日") for _ in range(rng.randint(0, 30))).encode()
        signs = [x if x >= 128 else ord(chr(x).lower()) if chr(x).isalpha() else 32 for x in text]
        assert cross_parse.folded(text) == b" ".join(w for w in bytes(signs).split(b" ") if w)


@pytest.mark.parametrize("lanes", [1, 3, 10_000])
def test_blocks_of_lanes_count_as_one(monkeypatch, lanes):
    rng = random.Random(5)
    parser = cross_parse.Parser((("x", (b"abcabcaab",)), ("y", (b"bcd bcd",))))
    texts = [bytes(rng.choice(b"abcd e") for _ in range(n)) for n in (0, 3000, 1, 512, 513, 0, 1024, 7000, 5)]
    whole = [sum(parser.phrases([t[i : i + cross_parse.LANE]])[0] for i in range(0, max(1, len(t)), cross_parse.LANE)).tolist() for t in texts]
    monkeypatch.setattr(cross_parse, "LANES", lanes)
    assert parser.phrases(texts).tolist() == whole


def test_a_very_long_text_takes_bounded_memory():
    samples = (("x", (b"the cat sat on the mat and so on",)), ("y", (b"el gato esta en la casa y mas",)))
    text = b"The Cat, sat on the mat. " * 800_000
    parser = cross_parse._parser(samples)
    tracemalloc.start()
    names, scores = cross_parse.predict([b"the cat sat on the mat", text], samples)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names == ["x", "x"] and parser.names == ["x", "y"]
    assert most < 8 * len(text)


def test_tables_are_built_in_bounded_memory():
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz äöüß"
    samples = tuple((name, tuple("".join(rng.choice(letters) for _ in range(768)).encode() for _ in range(64))) for name in "abcd")
    tracemalloc.start()
    parser = cross_parse.Parser(samples)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(t.nbytes for t in parser.tables) < 64 << 20
    assert most < held + (48 << 20)


def test_kept_columns_are_not_overwritten(spark):
    docs = spark.createDataFrame([(1, "the cat", 7.5, "fr", "x")], "doc_id BIGINT, text STRING, score DOUBLE, lang_pred STRING, body STRING")
    samples = (("en", (b"the cat sat",)), ("es", (b"el gato",)))
    names = cross_parse.added_names(docs)
    row = cross_parse.identify(docs, samples, keep=True).first()
    assert (row.score, row.lang_pred, row.body, row.text) == (7.5, "fr", "x", "the cat")
    assert row[names["lang_pred"]] == "en" and 0 < row[names["score"]] <= 1


def test_long_texts_use_several_lanes():
    parser = cross_parse.Parser((("x", (b"abcabc",)),))
    text = b"abcabc" * 1000
    assert parser.phrases([text, b"abc"])[:, 0].tolist() == pytest.approx([1000 + len(text) / cross_parse.LANE, 1], rel=0.02)


def test_every_row_gets_a_language(spark):
    rows = documents() + [(999, "12345 !! ??", "en", "s1", 1, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = cross_parse.with_languages(df).collect()
    assert len(got) == len(rows)
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows if r[0] is not None}
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not letters[r.doc_id])
        else:
            assert r.held_out
    assert cross_parse.with_languages(df.where("1 = 0")).collect() == []
    unlabelled = cross_parse.with_languages(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = cross_parse.with_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98
