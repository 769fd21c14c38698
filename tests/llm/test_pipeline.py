"""The corpus pipeline on planted documents, against plain versions of its stages."""

import random

import pytest
import sentencepiece
from llm.test_decontaminate import brute as contaminated
from llm.test_exact_dedup import brute as exact
from llm.test_simhash import plain_components, plain_fingerprint

import corpus_pipeline as P
from sitelens.llm.sentencepieces import read_model

BAD = ["vilko", "vilkan", "grumzel", "snarp"]


def planted():
    rnd = random.Random(12)
    words = [f"{a}{b}" for a in "ba do ka li mo ne pu ra si tu".split() for b in "ber lan mit nos pel rok tas".split()]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    docs, labels = {}, []
    for i in range(260):
        docs[i] = prose(rnd.randrange(60, 120))
        if i % 5 == 0:
            text = docs[i].split()
            for _ in range(4):
                text.insert(rnd.randrange(len(text)), rnd.choice(BAD))
            docs[i] = " ".join(text)
        labels.append((i, int(i % 5 == 0)))
    items = [(k, prose(16)) for k in range(6)]
    for k in range(8):
        docs[300 + k] = docs[1 + 5 * k].replace(" ", "  ")                     # longer copies stay
        near = docs[2 + 5 * k].split()
        near[40] = "other"
        docs[320 + k] = " ".join(near)
        docs[340 + k] = f"{prose(30)} {items[k % 6][1]} {prose(30)}"
    docs[400], docs[401] = "", "   "
    return docs, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels, items = planted()
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(
        4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_matches_the_plain_stages(spark, folder):
    docs, _, items = planted()
    left = {i: t for i, t in docs.items() if not any(w.startswith(tuple(BAD)) for w in t.split())}
    left = {k: left[k] for _, k, *_ in exact(left.items())}
    fps = [plain_fingerprint(t, 3) for t in left.values()]
    left = {c: left[c] for _, _, c in plain_components(list(left), fps, 3)}
    hit = {d for d, _, n, _ in contaminated(left.items(), items) if n}
    left = {i: t for i, t in left.items() if i not in hit}
    library = sentencepiece.SentencePieceProcessor(model_proto=read_model())
    got = P.run(spark, folder).collect()
    assert {r.doc_id: list(r.token_ids) for r in got} == {i: library.encode(t) for i, t in left.items()}
    assert all(r.round_trip and r.text == left[r.doc_id] and r.n_tokens == len(r.token_ids) for r in got)
    assert not set(left) & set(range(340, 348)) and 250 > len(left) > 150


def test_stages_keep_the_columns_and_take_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    empty = docs.limit(0)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, empty, folder).columns == names, name
    out = P.STAGES[-1][1](spark, empty, folder)
    assert out.columns == [*names, "token_ids", "round_trip", "n_tokens"] and out.count() == 0
