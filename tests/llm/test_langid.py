from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyweave.llm.common import crc_mod
from keyweave.llm.langid import accepted, fit_temperature, grams, identify, train
from tests.llm.conftest import odd_rows

SYLLABLES = {"aa": "ka la ma na", "bb": "ter ver sten ung", "cc": "éou èle ñir çao"}


def sample(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        s = SYLLABLES[lang].split()
        text = " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4)))
                        for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang))
    return rows


@pytest.fixture(scope="module")
def model(documents):
    return train(documents(sample()), crc_mod("doc_id", 3) != 1)


def test_held_out_accuracy_and_sparsity(documents, model):
    docs = documents(sample())
    out = identify(docs, model).where(crc_mod("doc_id", 3) == 1).collect()
    assert len(out) > 80
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out)
    assert (model.weights == 0).mean() > 0.5


def test_odd_rows(documents, model):
    rows = odd_rows(5000)
    out = identify(documents(rows).withColumn("score", F.lit("old")), model)
    assert out.columns.count("score") == 1 and out.schema["score"].dataType.simpleString() == "double"
    got = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert len(got) == len(rows)
    und = {i for i, p in got if p == "und"}
    assert und == {1, 2, 3, 4}
    kept = accepted(documents(rows), model, min_score=0.0).collect()
    assert {r.doc_id for r in kept} == {None, 5, 6, 7}


def test_no_training_rows(documents):
    empty = train(documents([]), F.lit(True))
    got = identify(documents([(1, "abc", None), (2, None, None)]), empty).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert [r.doc_id for r in accepted(documents([(1, "abc"), (2, "12")]), empty).collect()] == [1]
    one = train(documents([(1, "abc", "xx"), (2, "bcd", "xx"), (3, "de", None)]), F.lit(True))
    assert [(r.lang_pred, r.score) for r in identify(documents([(9, "z")]), one).collect()] == [
        ("xx", 1.0)]


def test_grams_count_letters_only():
    a, b = grams("Ab  c!", 14), grams("ab, 3 C", 14)
    assert sorted(a.tolist()) == sorted(b.tolist())
    assert len(a) == (3 * 6 - 3)  # " ab c ": 6 one-, 5 two- and 4 three-grams


def test_temperature_flattens_overconfident_scores():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 1, (2000, 3))
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert abs(fit_temperature(4 * z, y) - 4) < 0.6


def test_rare_languages_are_learnt(documents):
    rows = [(i, t, y) for i, t, y in sample(3000)]
    rows += [(5000 + i, "zhuzhi zhozhu " * 5, "dd") for i in range(3)]
    few = train(documents(rows), F.lit(True), fit_rows=60)
    assert few.languages == ["aa", "bb", "cc", "dd"]
    assert few.predict("zhuzhi zhozhu zhuzhi")[0] == "dd"


def test_the_stage_keeps_short_and_mixed_documents(spark, documents):
    import corpus_pipeline

    rng = random.Random(8)  # wrong labels make the scores small
    labelled = [(i, t, y if i % 2 else rng.choice("aa bb cc".split())) for i, t, y in sample()]

    unsure = [(1000, "x", None), (1001, "ka sten çao", None), (1002, "ten 1 + 2 = 3", None),
              (1003, "la ter nir", None), (1004, "wq", None), (1005, "kater vernas", None)]
    docs = documents(labelled + unsure + [(1006, "12 !", None), (1007, None, None)])
    assert accepted(documents(unsure), train(docs, F.lit(True))).count() < len(unsure)
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert left == set(range(400)) | {r[0] for r in unsure}


def test_letters_of_all_planes_count():
    for code in (0x30000, 0x31350, 0x20000, 0x1E900):
        assert len(grams(chr(code), 14)) == 6, hex(code)  # " x ": three, two and one grams


def test_the_stage_names_the_languages(spark, documents):
    import corpus_pipeline

    rows = [(i, t, y) for i, t, y in sample()]
    true = {i: y for i, _, y in rows}
    given = [(i, t, None if i % 10 == 0 else "cc" if i % 10 == 1 else y) for i, t, y in rows]
    docs = documents([*given, (1000, "12 !", "aa")])
    out = corpus_pipeline.language_id(spark, docs, "")
    assert out.schema == docs.schema
    found = {r.doc_id: (r.lang, r.text) for r in out.collect()}
    assert {i: t for i, (_, t) in found.items()} == {i: t for i, t, _ in rows}
    wrong = [i for i, (y, _) in found.items() if y != true[i]]
    assert len(wrong) < 0.02 * len(rows), wrong
    no_labels = documents([(1, "ka", None), (2, "1", None)])
    assert [tuple(r)[:3] for r in corpus_pipeline.language_id(spark, no_labels, "").collect()] == [
        (1, "ka", None)]
