from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from keyweave.llm.kronecker import Fields, Packed, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def valid(rows):
    return [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]


def brute(rows, every):
    good = valid(rows)
    out = []
    for n, (a, v, y) in enumerate(good):
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z == y)
                        for m, (i, w, z) in enumerate(good) if m != n)
        for s, i, same in [x for x in scored if x[2]][:5]:
            fits = [(t, j) for t, j, z in scored
                    if not z and 80 * -s <= 100 * -t and 100 * -t <= 100 * -s]
            out += [(a, i, r, j, -s, -t) for r, (t, j) in enumerate(fits[:5], 1)]
    return sorted(out)


def run(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives(df, F.col("vec_id") % every == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(rng, n, dims=10, labels=3):
    return [(i, [rng.randint(-30, 40) / 64 for _ in range(dims)], rng.randrange(labels))
            for i in range(n)]


def test_packed_products_are_exact():
    rng = np.random.default_rng(1)
    for least, most in ((-200, 180), (0, 5), (-1, 0), (7, 9), (-2**40, 2**41), (-2**62, 2**62)):
        x = rng.integers(least, most + 1, (50, 12))
        x[0], x[1] = least, most  # sums at the ends of a field
        fields = Fields(least, most, 12)
        packed = Packed(fields, fields.pack(x), len(x))
        for a in x[:6]:
            want = [sum(int(p) * int(q) for p, q in zip(a, row)) for row in x]
            assert packed.scores(fields.biased(a[None])[0]).tolist() == [
                max(1 - 2**63, min(2**63 - 1, s)) for s in want]


def test_equals_brute_force_over_tiles(spark):
    rows = vectors(random.Random(3), 400)
    same = rows[0][1]  # many equal vectors under two labels: ties go to the smaller id
    rows += [(1000 + i, same, i % 2) for i in range(80)]
    assert run(spark, rows, block=64, anchor_block=16) == brute(rows, 5)


def test_one_label_has_most_rows_and_labels_of_one_row(spark):
    rng = random.Random(4)
    rows = [(i, v, 0 if i % 3 else i) for i, v, _ in vectors(rng, 240)]
    assert run(spark, rows, block=64, anchor_block=8) == brute(rows, 5)


def test_invalid_short_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(random.Random(5), 60, dims=4)
    rows += [(100, None, 1), (105, [0.1, None, 0.2], 1), (110, [nan, 0.0], 1), (115, [inf], 0),
             (None, [0.5, 0.5, 0.5, 0.5], 1), (120, [0.5] * 4, None), (125, [0.5], 1), (130, [], 2)]
    rows += [(5, [0.6, 0.6, 0.1, 0.0], 0)] * 3  # an id that repeats: each row counts
    assert run(spark, rows) == brute(rows, 5)


def test_huge_components_are_held_at_64_bits(spark):
    rows = [(0, [1e30, 0.0], 0), (1, [1e30, 0.0], 0), (2, [1e30, 1.0], 1), (3, [-0.1, 0.1], 1)]
    got = run(spark, rows)
    assert [r[:4] for r in got] == [(0, 1, 1, 2)] and got[0][4] == 2**63 - 1


def test_few_rows_empty_table_and_clashing_columns(spark):
    rows = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.9], 1)]
    assert run(spark, rows) == brute(rows, 5) != []
    assert run(spark, [(0, [1.0], 0)]) == [] and run(spark, []) == []
    df = spark.createDataFrame([(*r, 7, 8, 9, 9) for r in rows],
                               SCHEMA + ", rid int, cb int, qb int, `v.x` int")
    assert hard_negatives(df, F.col("vec_id") % 5 == 0).count() == 1
