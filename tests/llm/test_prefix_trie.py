from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyweave.llm import prefix_trie as pt
from keyweave.llm.queries import branch_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            digest = hashlib.md5((x or "").encode()).hexdigest()
            own[c].append(((t is not None, t or 0, r or "", digest), (r or "", x or "")))
    own = {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        base, h = c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9
        out[c] = turns if base == c else own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members, last = defaultdict(list), {}
    for c, q in sequences.items():
        for d in range(len(q) + 1):
            members[tuple(q[:d])].append(c)
    kids = defaultdict(list)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        last[n] = (sum(last[k][0] for k in kids[n]) or 1, own + sum(last[k][1] for k in kids[n]))
    out = []
    for n, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(sequences[c]) == len(n)))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), len(kids[n]),
                    *last[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def run(spark, rows, **kw):
    got = branch_trie(spark.createDataFrame(rows, SCHEMA), **kw)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0]))


def talks(rng, n, most, kinds=2):
    """Conversations of few different turns, so that they share prefixes."""
    return [(c, t, "user" if t % 2 == 0 else "bot", f"t{rng.randrange(kinds)}é")
            for c in range(n) for t in range(rng.randrange(most + 1))]


@pytest.mark.parametrize("local_weight", [8, 1 << 15])
def test_equals_brute_force(spark, local_weight):
    rng = random.Random(local_weight)
    rows = talks(rng, 60, 7)
    rows += [(100 + i, t, "user", "hi") for i in range(40) for t in range(6)]  # copies
    rng.shuffle(rows)
    assert run(spark, rows, local_weight=local_weight) == brute(rebuilt(rows))


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 16)
    rows = [(c, t, "user", f"{t}" if t < 90 - c else f"{c}-{t}") for c in (0, 5, 10, 15)
            for t in range(150)]
    assert run(spark, rows, local_weight=100) == brute(rebuilt(rows))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "bot", "b"),
            (1, 0, "bot", "a"), (2, 5, None, "q"), (2, 5, None, "q"), (-3, 1, "user", "neg"),
            (7, 0, "user", "long " * 20_000), (8, 0, "user", "long " * 20_000), (0, 0, "user", "é")]
    assert run(spark, rows) == brute(rebuilt(rows))  # a negative id's base is towards 0, as in SQL


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "x")]) == []
    rows = talks(random.Random(3), 12, 4)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows],
                               SCHEMA + ", c int, pos int, d int, `a.b` int")
    got = branch_trie(df)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0])) == brute(
        rebuilt(rows))


def test_rounds_are_logarithmic_in_a_chain():
    n = 5000
    parent = np.arange(-1, n - 1)
    top, depth, weight = np.zeros(n, np.int64), np.arange(n), np.arange(n, 0, -1)
    values = np.stack([np.ones(n, np.int64), np.arange(n)], 1)
    got = pt._split_local(top, parent, depth, weight, values, np.zeros((n, 2), np.int64))
    assert (got[:, 0] == weight).all()
    assert (got[:, 1] == np.cumsum(values[::-1, 1])[::-1]).all()


def test_totals_of_random_forests():
    rng = np.random.default_rng(5)
    for n in (1, 2, 40, 700):
        parent = np.array([-1 if i == 0 or rng.random() < 0.02 else rng.integers(max(0, i - 9), i)
                           for i in range(n)])
        own, values = rng.integers(1, 50, n), rng.integers(-9, 99, (n, 2))
        weight, want, depth, top = own.copy(), values.copy(), np.zeros(n, int), np.arange(n)
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                weight[parent[i]] += weight[i]
                want[parent[i]] += want[i]
        for i in range(n):
            if parent[i] >= 0:
                depth[i], top[i] = depth[parent[i]] + 1, top[parent[i]]
        got = pt._split_local(top, parent, depth, weight, values, np.zeros((n, 2), np.int64))
        assert (got == want).all()


def test_no_conversation_is_one_group(spark):
    rows = [(3, t, "user", "same") for t in range(3000)] + [(4, t, "user", "x") for t in range(50)]
    turns = pt.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert sorted(r.pos for r in turns.where("c = 3").collect()) == list(range(1, 3001))
    plan = turns._jdf.queryExecution().toString()
    assert "windowspecdefinition(c" in plan and "chunk" in plan
    assert turns.where("c = 3").select(F.max("size")).first()[0] == 4
