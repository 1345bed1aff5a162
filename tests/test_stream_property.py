"""Streaming joins equal the record-at-a-time simulation on random cases.

Independent cases (own keys and empIds) go through one streaming query, split
into micro-batches by arrival position. Arrival order is the micro-batch, then
the position inside it, so the simulation runs on exactly that order.
"""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import types as T

from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.session import ensure_checkpoint_dir
from keyweave.sources.conform import conform
from keyweave.sources.files import raw_schema
from keyweave.streaming.join import eager_join_stream, settled_join_stream
from tests.simulate import settled, simulate
from tests.test_property import W, case_of_id, make_cases
from tests.test_fixtures import P

BATCHES = 3


def _write(mk, folder, cases, sentinel: bool):
    rows = {"L": [[] for _ in range(BATCHES + 1)], "R": [[] for _ in range(BATCHES + 1)]}
    n = sum(len(r) for r in cases)
    pos = 0
    for recs in cases:
        for r in recs:
            rows[r["side"]][pos * BATCHES // n].append(
                (r["key"], r["ts"], r["id"], r["value"], r["seq"]))
            pos += 1
    if sentinel:  # far in the future: closes every group of the cases
        rows["L"][BATCHES].append(("sentinel", 10**9, 10**9, P(999999), 10**9))
    for side, kind in (("L", "personal"), ("R", "address")):
        for i, part in enumerate(rows[side]):
            mk(kind, part, seq=True).coalesce(1).write.parquet(f"{folder}/{kind}/part-{i:04d}")


def _src(spark, folder, kind):
    schema = T.StructType(raw_schema(kind).fields + [T.StructField("seq", T.LongType())])
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .parquet(f"{folder}/{kind}/part-*"))
    return conform(s, kind).ok


def _run(spark, folder, j):
    q = (j.writeStream.format("parquet").outputMode("append")
         .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").start())
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(f"{folder}/out").where("key is null or key != 'sentinel'")


@pytest.fixture
def folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sprop-{uuid.uuid4().hex[:8]}"


def _global_seq(cases):
    s = 0
    for recs in cases:
        for r in recs:
            r["seq"] = s
            s += 1


def test_eager_stream_matches_simulation(spark, mk, folder):
    # shuffled arrival, carried as the explicit arrival sequence ``seq``
    cases = make_cases(31, 60, shuffle=True, key_is_emp=False)
    _global_seq(cases)
    _write(mk, folder, cases, sentinel=False)
    j = eager_join_stream(_src(spark, folder, "personal"), _src(spark, folder, "address"),
                          window_ms=W, arrival="seq")
    rows = _run(spark, folder, j).select("l_id", "r_id", *ORDER_COLUMNS).collect()
    owner = case_of_id(cases)
    by_case: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: tuple(
            (x is not None, x) for x in (r[c] for c in ORDER_COLUMNS))):
        by_case.setdefault(owner[r.l_id if r.l_id is not None else r.r_id], []).append(
            (r.l_id, r.r_id))
    total = 0
    for c, recs in enumerate(cases):
        emitted, _ = simulate(sorted(recs, key=lambda r: r["seq"]), W)
        total += len(emitted)
        assert by_case.get(c, []) == emitted, f"case {c}"
    assert total > 100


def test_settled_stream_matches_simulation(spark, mk, folder):
    cases = make_cases(57, 60, shuffle=False, key_is_emp=False)
    # in event-time order across the whole run, so no row is behind the watermark
    flat = sorted((r for recs in cases for r in recs),
                  key=lambda r: (r["ts"], 0 if r["side"] == "L" else 1, r["id"]))
    for i, r in enumerate(flat):
        r["seq"] = i
    _write_in_seq_order(mk, folder, flat)
    j = settled_join_stream(_src(spark, folder, "personal"), _src(spark, folder, "address"),
                            window_ms=W, grace="1 second")
    got = [(r.l_id, r.r_id) for r in _run(spark, folder, j).collect()]
    assert len(got) == len(set(got))
    want = set().union(*[settled(recs, W) for recs in cases])
    assert set(got) == want


def _write_in_seq_order(mk, folder, flat):
    rows = {"L": [[] for _ in range(BATCHES + 1)], "R": [[] for _ in range(BATCHES + 1)]}
    for pos, r in enumerate(flat):
        rows[r["side"]][pos * BATCHES // len(flat)].append(
            (r["key"], r["ts"], r["id"], r["value"], r["seq"]))
    rows["L"][BATCHES].append(("sentinel", 10**9, 10**9, P(999999), 10**9))
    for side, kind in (("L", "personal"), ("R", "address")):
        for i, part in enumerate(rows[side]):
            mk(kind, part, seq=True).coalesce(1).write.parquet(f"{folder}/{kind}/part-{i:04d}")
