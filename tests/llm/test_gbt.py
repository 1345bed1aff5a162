from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from keyweave.llm.common import crc_mod
from keyweave.llm.gbt import FEATURES, fit, predict, statistics, train
from tests.llm.conftest import odd_rows, prose


def walk(t, x):
    raw = t.base
    for root in t.roots:
        at = root
        while t.left[at] != at:
            at = t.left[at] if x[t.feature[at]] <= t.threshold[at] else t.right[at]
        raw += t.value[at]
    return 1 / (1 + np.exp(-raw))


def test_vectorised_traversal_equals_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = fit(x, y, rounds=30, depth=3)
    assert np.allclose(t.score(x), [walk(t, r) for r in x])
    assert ((t.score(x) > 0.5) == (y == 1)).mean() > 0.97


def test_no_rows_or_one_class():
    x = np.zeros((4, len(FEATURES)))
    assert fit(x[:0], np.zeros(0)).score(x)[0] == 0.5
    assert fit(x, np.ones(4)).score(x)[0] > 0.99


def quality(i):
    return [f"na na na na {'na ' * (i % 40 + 20)}", prose(i, 40 + i % 50),
            prose(i, 60).upper().replace(" ", "!! ")][i % 3], int(i % 3 == 1)


def test_held_out_accuracy(spark, documents):
    docs = documents([(i, quality(i)[0]) for i in range(600)])
    labels = spark.createDataFrame([(i, quality(i)[1], None) for i in range(600)]
                                   + [(1, None, 0), (None, 1, 0), (2, 7, 0), (3, quality(3)[1], 0)],
                                   "doc_id long, quality int, toxic int")
    trees = train(docs, labels, crc_mod("doc_id", 5) != 0)
    out = predict(docs.withColumn("score", F.lit("old")), trees).where(crc_mod("doc_id", 5) == 0)
    rows = out.collect()
    assert out.columns.count("score") == 1 and len(rows) > 80
    assert np.mean([r.predicted == quality(r.doc_id)[1] for r in rows]) > 0.97
    few = train(docs, labels, crc_mod("doc_id", 5) != 0, fit_rows=50)
    assert len(few.roots) > 0


def test_odd_rows_and_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    trees = train(documents([]), labels, F.lit(True))
    rows = odd_rows(5000)
    out = predict(documents(rows).select("doc_id", "text"), trees).collect()
    assert len(out) == len(rows) and {r.score for r in out} == {0.5}
    assert predict(documents([]), trees).count() == 0
    assert statistics(None) == statistics("") == [0.0] * len(FEATURES)
    assert all(np.isfinite(statistics(t)).all() for _, t, *_ in rows)


def test_repeated_ids_give_one_row_each_and_any_column_names(spark, documents, monkeypatch):
    from keyweave.llm import gbt

    seen = []
    real = gbt.fit
    monkeypatch.setattr(gbt, "fit", lambda x, y, **kw: seen.append(x) or real(x, y, **kw))
    rows = [(i, quality(i)[0]) for i in range(60)] + [(7, prose(900 + j, 30)) for j in range(40)]
    labels = spark.createDataFrame([(i, quality(i)[1], 0) for i in range(60)],
                                   "doc_id long, quality int, toxic int")
    train(documents(rows), labels, F.lit(True), fit_rows=50)
    train(documents(rows[::-1]).repartition(5), labels, F.lit(True), fit_rows=50)
    assert len(seen[0]) == 50 and (seen[0] == seen[1]).all()
    trees = real(np.zeros((0, len(FEATURES))), np.zeros(0))
    odd = documents(rows[:3]).select("doc_id", "text", F.lit(1).alias("a.b"))
    assert predict(odd, trees).columns == ["doc_id", "a.b", "score", "predicted"]
