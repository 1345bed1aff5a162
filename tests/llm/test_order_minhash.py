from __future__ import annotations

import random

import numpy as np

import keyweave.llm.order_minhash as om

from keyweave.llm.order_minhash import (
    alignment_similarity,
    _rare_pairs,
    deduplicate,
    labelled_shingles,
    near_duplicates,
    order_sketches,
    propagate,
)
from tests.llm.conftest import odd_rows, prose


def edited(text: str, edits: int, seed: int) -> str:
    rng, ws = random.Random(seed), text.split(" ")
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"edit{rng.randrange(10**6)}"
    return " ".join(ws)


def lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_equals_longest_common_subsequence():
    rng = np.random.default_rng(2)
    seen = 0
    for t in range(300):
        a = rng.permutation(60)[:rng.integers(1, 50)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 6)))
        b = np.insert(b, rng.integers(0, len(b) + 1, rng.integers(0, 4)), 99)
        if t % 3 == 0:
            b = rng.permutation(b)
        c = lcs(a.tolist(), b.tolist())
        want = c / (len(a) + len(b) - c) if len(b) else 0
        got = alignment_similarity(a, b, 0.8)
        assert abs(got - (want if want >= 0.8 else 0.0)) < 1e-9
        seen += got > 0
    assert seen > 50


def classes(df):
    return {r.doc_id: r.class_id for r in df.collect()}


def brute(rows):
    """Connected components of exact copies and of all pairs at 0.8."""
    s = [labelled_shingles(t, 5) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is not None and (rows[i][1] == rows[j][1] or
                                           alignment_similarity(s[i], s[j], 0.8)):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            k = find(i)
            least[k] = min(least.get(k, r[0]), r[0])
    return {r[0]: least[find(i)] for i, r in enumerate(rows) if r[0] is not None}


def test_classes_equal_all_pairs(spark, documents):
    rows, n = [], 0
    for g in range(12):
        base = prose(100 + g, 150)
        for e in (0, 1, 2, 3, 12, 60):
            rows.append((n, edited(base, e, n)))
            n += 1
    shared = prose(7, 70)  # a passage of half of each of these texts is no near duplicate
    rows += [(n + i, shared + " " + prose(500 + i, 70)) for i in range(25)]
    rows += [(n + 100 + i, rows[0][1]) for i in range(40)]  # copies
    rows += [(n + 200 + i, edited(rows[6][1], 1, i)) for i in range(40)]  # near copies
    got = classes(near_duplicates(documents(rows)))
    assert got == brute(rows)


def test_odd_rows(spark, documents):
    rows = odd_rows(3000) + [(10, ""), (11, None), (12, "X!"), (13, edited(prose(5, 80), 1, 3))]
    out = near_duplicates(documents(rows))
    assert out.count() == len(rows)
    got = classes(out)
    assert got[10] == got[2] and got[11] == 11 and got[1] == 1 and got[13] == 5
    assert got[12] == 7  # one word is one shingle
    kept = deduplicate(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x)) == [
        None, 1, 2, 3, 4, 5, 6, 7, 11]


def test_empty_table(spark, documents):
    assert near_duplicates(documents([])).count() == 0
    assert deduplicate(documents([])).count() == 0


def test_version_chains_and_slots_equal_all_pairs(spark, documents):
    rows, base = [], prose(31, 170)
    for g in range(12):  # chains: each version is near the one before only
        text = edited(base, 9, 50 + g)
        for v in range(12):
            rows.append((len(rows), text))
            text = edited(text, 3, 1000 * g + v)
    slots = prose(32, 200).split(" ")
    for i in range(60):  # one text with slots that are filled anew
        ws = list(slots)
        for j in range(0, 200, 29 if i % 2 else 41):
            ws[j] = f"slot{i % 7}{j}" if i % 3 else f"own{i}"
        rows.append((len(rows), " ".join(ws)))
    assert classes(near_duplicates(documents(rows))) == brute(rows)


def test_every_pair_of_a_fine_bucket_is_met(spark, documents):
    rows, want = [], {}
    for g in range(30):  # a and c are too far apart, b is near both
        b = prose(4000 + g, 150).split(" ")
        a, c = list(b), list(b)
        for j in (10, 50, 90):
            a[j], c[j + 20] = f"a{g}x{j}", f"c{g}x{j}"
        texts = [" ".join(ws) for ws in (a, b, c)]
        s = [labelled_shingles(t, 5) for t in texts]
        assert alignment_similarity(s[0], s[1], 0.8) and alignment_similarity(s[1], s[2], 0.8)
        assert not alignment_similarity(s[0], s[2], 0.8)
        if len({int(order_sketches(x, 1, 1)[0]) for x in s}) == 1:  # all in one bucket
            want |= {3 * g + i: 3 * g for i in range(3)}
        rows += [(3 * g + i, t) for i, t in enumerate(texts)]
    assert len(want) > 45
    got = classes(near_duplicates(documents(rows), bands=1, rows=1, tuple_size=1, fine_bands=1,
                                  fine_rows=1))
    assert {i: got[i] for i in want} == want


def test_rare_shingles_lose_no_pair(spark):
    rows = []
    for g in range(6):
        base = prose(900 + g, 60 + 30 * g)
        rows += [edited(base, e, 10 * g + e) for e in (0, 1, 2, 4, 8)]
    shared = prose(77, 60)
    rows += [shared + " " + prose(600 + i, 60) for i in range(40)]
    ids = [b"%03d" % i for i in range(len(rows))]
    got = {tuple(sorted((r.a, r.b))) for r in _rare_pairs(spark.createDataFrame(
        [(bytearray(i), bytearray(i), t) for i, t in zip(ids, rows)],
        "tid binary, root binary, text string"), 5, 0.8).collect()}
    got = {(bytes(a), bytes(b)) for a, b in got}
    s = [labelled_shingles(t, 5) for t in rows]
    near = {(ids[j], ids[i]) for i in range(len(rows)) for j in range(i)
            if alignment_similarity(s[i], s[j], 0.8)}
    assert near and near <= got
    assert len(got) < 3 * len(near)  # the 780 pairs that share half their words are none


def test_a_group_below_the_threshold_gives_few_pairs(spark, documents, monkeypatch):
    """Texts that share a bucket but are not near: no square of them is compared."""
    base, n = prose(5, 200), 150
    rows = [(i, edited(base, 9, 70 + i)) for i in range(n)]
    made = []
    real = om._rare_pairs
    monkeypatch.setattr(om, "_rare_pairs", lambda *a: made.append(real(*a).count()) or real(*a))
    got = classes(near_duplicates(documents(rows)))
    assert got == brute(rows)
    assert made and made[0] < 10 * n < n * n / 2


def test_a_chain_of_200_versions_takes_few_steps(spark, monkeypatch):
    n, steps = 200, []
    real = om.materialise
    monkeypatch.setattr(om, "materialise", lambda df, name: steps.append(name) or real(df, name))
    tid = lambda i: bytearray(b"%04d" % i)
    # each version is near the one before: its centre
    stars = [(tid(i), tid(i), tid(i)) for i in range(n)]
    stars += [(tid(i + 1), tid(i), tid(i + 1)) for i in range(n - 1)]
    out = propagate(spark.createDataFrame(stars, "member binary, centre binary, label binary"), "s")
    assert {bytes(r.label) for r in out.collect()} == {b"0000"}
    assert steps.count("s") <= 12


def test_clashing_column_names(spark):
    rows = [(1, "a b c d e f g", 7, 7, 7, 7), (2, "a b c d e f g", 8, 8, 8, 8), (3, None, 9, 9, 9, 9)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, _tid int, w_tid int, w_id int, `a.b` int")
    out = deduplicate(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert near_duplicates(df).count() == 3


def test_sketches_need_little_memory():
    import tracemalloc

    s = np.random.default_rng(1).integers(0, 2**64, 3000, np.uint64)
    whole = order_sketches(s, 1280, 2)
    tracemalloc.start()
    try:
        again = order_sketches(s, 1280, 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (again == whole).all() and peak < 12_000_000  # 3000 * 1280 hashes are 31 MB
