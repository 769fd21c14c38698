"""Token counts against the library that reads the vocabulary file."""

import random

import pytest
from tokenizers import Tokenizer

from sitelens.llm import token_counts as C
from sitelens.llm.common import tokenizer_path

VOCABULARY = C.read_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(C.VOCABULARY))


def samples():
    rnd = random.Random(3)
    pool = "aab é1 2\n  \tあ。🙂'sll,.!<|endoftext|> the"
    words = ["the", " and", "<|endoftext|>", "\n\n", "  ", "1234", "naïve", "'s", "中文", "。", "!?", " ", "x" * 30]
    for k in range(400):
        yield "".join(rnd.choices(pool if k % 2 else words, k=rnd.randrange(0, 120)))


def test_counts_match_the_library(library):
    c = C.Counter(*VOCABULARY)
    for text in samples():
        assert c.ids(text) == library.encode(text, add_special_tokens=False).ids if text else c.count(text) == 0


def test_stable_places_split_every_text(library):
    """Encoding both sides of a stable place alone gives the tokens of the whole."""
    c = C.Counter(*VOCABULARY)
    for text in samples():
        ids = c.ids(text) if text else []
        at, before = c.boundaries(text, ids, 0, len(text))
        for x, n in zip(at, before, strict=True):
            assert c.ids(text[:x]) == ids[:n] and c.ids(text[x:]) == ids[n:]


def test_documents(spark, library):
    rnd = random.Random(8)
    texts = ["".join(rnd.choices(["the ", "fox", "<|endoftext|>", "é", "\n", "12", " "], k=400)),
             "x" * 900, "中" * 700 + "。" + "文" * 300, "ab" * 300 + " " + "cd" * 400, " " * 800, None, "", "short",
             "<|endoftext|>" * 90]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, n_tokens int").repartition(3)
    got = C.token_counts(docs, VOCABULARY, chunk=100, overlap=20).collect()
    want = []
    for d, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert C.token_counts(spark.createDataFrame([], "doc_id bigint, text string"), VOCABULARY).count() == 0
