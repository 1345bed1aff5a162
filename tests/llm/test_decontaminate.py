from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from keyweave.llm.decontaminate import decontaminate, measure
from tests.llm.conftest import odd_rows, prose


def words(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items, n=13):
    out = []
    for doc_id, t, *_ in docs:
        ws, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            m = min(n, len(iw))
            wins = {tuple(iw[i:i + m]) for i in range(len(iw) - m + 1)} if iw and item is not None else ()
            for i in range(len(ws) - m + 1):
                if tuple(ws[i:i + m]) in wins:
                    hit |= set(range(i, i + m))
                    found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(found), sha,
                    bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


ITEMS = [(1, prose(50, 40)), (2, prose(51, 13)), (10, "Three Ünder words"), (11, "!!"), (12, None),
         (None, prose(52, 20)), (13, prose(50, 40)), (14, "")]


def cases():
    a = prose(50, 40).split()
    return odd_rows(8000) + [
        (20, "x " + " ".join(a[:13]).upper() + " y"), (21, " ".join(a[:12])),
        (22, prose(60, 400) + " " + " ".join(a[5:25])), (23, "three Ünder words, and THREE Ünder words"),
        (24, "three ünder words"), (25, prose(51, 13).replace(" ", "--") + " " + prose(61, 20)),
        (26, " ".join(a[3:18] + a[10:30]))]


def table(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_equals_brute_force(spark, documents):
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute(cases(), ITEMS)
    docs = documents(cases())
    assert sorted((tuple(r) for r in measure(docs, table(spark)).select(*cols).collect()),
                  key=str) == want
    # the benchmark in parts gives the same
    parts = measure(docs, table(spark), max_windows=60).select(*cols)
    assert sorted((tuple(r) for r in parts.collect()), key=str) == want


def test_removes_documents_or_spans(spark, documents):
    docs = documents(cases())
    bad = {r[0] for r in brute(cases(), ITEMS) if r[5]}
    kept = decontaminate(docs, table(spark))
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {c[0] for c in cases()} - bad
    cut = {r.doc_id: r.text for r in decontaminate(docs, table(spark), remove="spans").collect()}
    assert cut[20] == "x  y" and cut[21] == " ".join(prose(50, 40).split()[:12])
    assert cut[1] is None and words(cut[23]) == ["and"]


def test_empty_tables_and_clashing_columns(spark, documents):
    docs = documents(cases()).withColumn("n_words", F.lit("old")).withColumn("_items", F.lit(1))
    out = measure(docs, table(spark).where("false"))
    assert {r.contaminated for r in out.collect()} == {False}
    assert out.columns.count("n_words") == 1 and out.schema["n_words"].dataType.typeName() == "long"
    assert measure(documents([]), table(spark)).count() == 0
