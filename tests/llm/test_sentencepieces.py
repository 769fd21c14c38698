"""SentencePiece encoding against the library, decoding by exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece

from sitelens.llm import sentencepieces as S

MODEL = S.read_model()


@pytest.fixture(scope="module")
def pieces():
    return S.Pieces(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def samples(n):
    rnd = random.Random(1)
    signs = "aab bcdeést  \n\téあ🙂<s>10.,ing the"
    for k in range(n):
        pool = signs if k % 2 else "abcingthestrue"
        yield "".join(rnd.choices(pool, k=rnd.randrange(1, 300)))
    yield from ["", " ", "  ", "a ", " a", "a  b ", "<0x0A>", "</s>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", " " * 70]


def test_words_match_the_library(pieces, library):
    texts = list(samples(300))
    assert pieces.encode([*texts, None]) == [*map(library.encode, texts), []]
    for text in texts:
        assert pieces.decode(library.encode(text)) == text == library.decode(library.encode(text))


@pytest.mark.parametrize("size", [17, 40, 100])
def test_chunks_match_the_library(pieces, library, size):
    for text in samples(150):
        if not text:
            continue
        parts = [c for _, c in S.chunks(text, size, pieces.longest)]
        at = S.scan([pieces.transfer(c) for c in parts])
        got = [i for c, e, x in zip(parts, at, at[1:], strict=False) for i in pieces.backtrace(c, e, x)]
        assert got == library.encode(text)


def test_products_are_associative(pieces):
    text = "".join(random.Random(4).choices("abcingthe", k=400))
    a, b, c = [pieces.transfer(c) for _, c in S.chunks(text, 100, pieces.longest)][:3]
    assert np.array_equal(S.multiply(S.multiply(a, b), c), S.multiply(a, S.multiply(b, c)))


def test_documents(spark, library):
    rnd = random.Random(6)
    giant = "".join(rnd.choices("ab cing thestrue\n", k=1000))
    solid = "".join(rnd.choices("abcingthestrue", k=700))
    rows = [(1, giant), (1, giant), (2, solid), (3, None), (4, ""), (5, "short é"), (None, giant + "x"), (6, " " * 500)]
    docs = spark.createDataFrame([(*r, [7], 3) for r in rows], "doc_id bigint, text string, token_ids array<int>, row int")
    got = S.encode(docs, MODEL, size=128).collect()
    assert sorted(((r.doc_id, r.text, list(r.token_ids), r.row) for r in got), key=repr) == sorted(
        ((d, t, library.encode(t or ""), 3) for d, t in rows), key=repr)


def test_queries_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a▁b", "x"), (2, None, "y")], "doc_id bigint, text string, n_tokens string")
    got = {r.doc_id: r for r in S.encode_documents(docs).collect()}
    assert got[1].round_trip and got[1].n_tokens == len(got[1].token_ids) > 0
    assert got[2].round_trip and got[2].n_tokens == 0
    assert S.encode_documents(docs.limit(0)).count() == 0
