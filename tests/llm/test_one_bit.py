from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from keyweave.llm.one_bit import (
    _encode,
    encode,
    nearest,
    opened,
    query_blocks,
    rotation,
    scan,
)

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, every, k):
    """query_id -> [(vec_id, score)], sums in the order of the components."""
    good = [(i, v) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (q, v) in enumerate(good):
        if q % every == 0:
            s = []
            for m, (i, w) in enumerate(good):
                if m != n:
                    t = 0.0
                    for a, b in zip(v, w):
                        t += a * b
                    s.append((-t, i))
            out += [(q, r, i, -t) for r, (t, i) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


def run(spark, rows, every=20, k=20, **kw):
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, k=k, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def unit(n, dims, seed):
    x = np.random.default_rng(seed).standard_normal((n, dims))
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def test_estimates_are_unbiased_and_inside_their_bound():
    x, q = unit(2000, 64, 1) * 3 + 0.2, unit(50, 64, 2)
    centre, rotate = x.mean(axis=0), rotation(64, 256, 7)
    assert np.allclose(rotate.T @ rotate, np.eye(64))
    packed, norms, cosines = encode(x, centre, rotate)
    signs = np.unpackbits(packed, axis=1) * 2.0 - 1
    got = (q @ centre)[:, None] + (q @ rotate.T / 16) @ signs.T * (norms / cosines)
    error = (got - q @ x.T) / (norms * np.sqrt(1 - cosines**2) / cosines / np.sqrt(255))
    assert abs(error.mean()) < 0.02 and 0.8 < error.std() < 1.1
    assert (np.abs(error) < 3).mean() > 0.995


def test_few_candidates_are_scored():
    x = unit(8000, 64, 3)
    centre, rotate = x.mean(axis=0), rotation(64, 256, 7)
    t = pa.table({"cb": pa.array([0] * len(x), pa.int32()), "rid": pa.array(range(len(x))),
                  "vec_id": pa.array(range(len(x))), "v": pa.array(x.tolist())})
    block = opened(_encode(64, centre, rotate)(t).to_pylist()[0], 64)
    found, scored = scan(x[:40], np.arange(40), block, centre, rotate, 20, 3.0)
    assert scored < 0.2 * 40 * 8000
    top = np.argsort(-(x[:40] @ x.T), axis=1)[:, 1:21]
    hit = [len(set(found.id[found.query == i]) & set(top[i])) for i in range(40)]
    assert sum(hit) >= 0.99 * 800


def test_recall_and_scores_over_tiles(spark):
    x = unit(1500, 32, 5)
    x[200:300] = x[7]  # a very common vector: ties go to the smaller id
    rows = list(enumerate(x.tolist()))
    want = brute(rows, 20, 20)
    got = run(spark, rows, block_bytes=256 * 32 * 8, query_block=16)
    assert len(got) == len(want) and len(set(got) & set(want)) >= 0.99 * len(want)
    exact = {(q, i): s for q, _, i, s in brute(rows, 20, len(rows))}
    assert all(exact[q, i] == s for q, _, i, s in got)
    assert run(spark, rows, errors=50.0) == want  # beyond any error: exact


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25, -1.0]), (1, None), (2, [0.1, None, 0.2]), (3, [nan, 0.0, 0.0]),
            (4, [inf, 0.0, 0.0]), (None, [0.5, 0.5, 0.5]), (5, [0.5]), (6, []), (8, [0.0, 0.0]),
            (20, [0.3, 0.3, 0.3]), (20, [0.3, 0.3, 0.3]), (20, [0.1, 0.9, 0.0]), (9, [2.0, 1.0, 4.0])]
    assert run(spark, rows) == brute(rows, 20, 20) != []


def test_few_rows_empty_table_one_vector_and_clashing_columns(spark):
    assert run(spark, [(0, [1.0]), (1, [0.5])]) == [(0, 1, 1, 0.5)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []
    same = [(i, [0.6, 0.8]) for i in range(50)]  # no spread at all around the mean
    assert run(spark, same) == brute(same, 20, 20)
    df = spark.createDataFrame([(0, [1.0], 3, 4, 5), (1, [2.0], 3, 4, 5)],
                               SCHEMA + ", rid int, is_query int, `a.b` int")
    assert [tuple(r) for r in nearest(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2.0)]


def test_what_a_tile_holds_does_not_grow_with_it():
    x = unit(20000, 64, 9)
    centre, rotate = x.mean(axis=0), rotation(64, 256, 7)
    t = pa.table({"cb": pa.array([0] * len(x), pa.int32()), "rid": pa.array(range(len(x))),
                  "vec_id": pa.array(range(len(x))), "v": pa.array(x.tolist())})
    tracemalloc.start()
    rows = _encode(64, centre, rotate)(t).to_pylist()
    coded = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    best = []
    for r in rows:
        scan(x[:1500], np.arange(1500), opened(r, 64), centre, rotate, 20, 3.0, best)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert coded < 60e6 and peak < 60e6
    assert len(rows) == 3 and max(len(r["vectors"]) for r in rows) < 5e6
    # slices and rows change nothing: the best of each query are those of a scan of its own
    found = [sorted(zip(b.query.tolist(), b.id.tolist(), b.score.tolist())) for b in best]
    top = np.argsort(-(x[:128] @ x.T), axis=1)[:, 1:21]
    hit = [len({i for p, i, _ in found[0] if p == n} & set(top[n])) for n in range(128)]
    assert sum(hit) >= 0.99 * 128 * 20 and len(found) == 12


def test_query_blocks_grow_where_tiles_are_many():
    assert query_blocks(2565, 512, 2) == 6 and query_blocks(100, 512, 1) == 1
    assert query_blocks(30000, 512, 20) == 8 and query_blocks(0, 512, 1) == 1
