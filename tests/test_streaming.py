"""Structured Streaming: file replay of hand-made and driver rows.

Each file is one micro-batch per stream (``maxFilesPerTrigger=1``), so files
set the arrival order. Results are compared with the batch operators.
"""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from keyweave.operators.interval_join import interval_outer_join
from keyweave.plans import catalog
from keyweave.session import ensure_checkpoint_dir
from keyweave.sources.conform import conform
from keyweave.sources.files import read_raw
from keyweave.streaming.join import eager_join_stream, settled_join_stream
from keyweave.streaming.replay import replay_stream, write_event_replay
from keyweave.streaming.table import read_state_table, read_table
from keyweave.streaming.topology import start_employee_table
from tests.test_fixtures import A, P

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex[:8]}"


def write_batches(mk, folder: str, kind: str, batches: list[list]) -> None:
    for i, rows in enumerate(batches):
        mk(kind, rows).coalesce(1).write.parquet(f"{folder}/{kind}/part-{i:04d}")


def src(spark, folder: str, kind: str):
    return conform(read_raw(spark, f"{folder}/{kind}/part-*", kind, streaming=True,
                            max_files_per_trigger=1), kind).ok


def run_to_end(df, folder: str, name: str) -> None:
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/ck-{name}")
         .start())
    q.processAllAvailable()
    q.stop()


def pairs(spark, path: str):
    rows = spark.read.parquet(path).orderBy(
        "emit_o1", "emit_side", "emit_id", "peer_t", "peer_o1", "peer_id").collect()
    return [(r.l_id, r.r_id) for r in rows]


def test_eager_arrival_follows_micro_batches(spark, mk, folder):
    # batch 0: right row; batch 1: a left row that is earlier in event time but
    # arrives later, plus an unrelated left row outside every window
    write_batches(mk, folder, "personal", [[], [("a", 10000, 1, P(1)), ("b", 50000, 3, P(2))]])
    write_batches(mk, folder, "address", [[("a", 10800, 2, A(1))], []])
    j = eager_join_stream(src(spark, folder, "personal"), src(spark, folder, "address"),
                          window_ms=1000)
    run_to_end(j, folder, "out")
    got = spark.read.parquet(f"{folder}/out").collect()
    nf = lambda v: (v is not None, v or 0)  # noqa: E731  nulls first
    got_pairs = sorted(((r.l_id, r.r_id) for r in got), key=lambda p: (nf(p[0]), nf(p[1])))
    assert got_pairs == [(None, 2), (1, 2), (3, None)]
    # the pair is emitted by the left row's arrival
    pair = [r for r in got if r.l_id == 1][0]
    assert (pair.emit_side, pair.emit_id) == (0, 1)


def test_eager_edges_and_many_to_many(spark, mk, folder):
    write_batches(mk, folder, "personal", [
        [("e", 10000, 1, P(1)), ("o", 10000, 3, P(2)),
         ("m", 10000, 5, P(3)), ("m", 10100, 6, P(3))],
    ])
    write_batches(mk, folder, "address", [
        [("e", 11000, 2, A(1)), ("o", 11001, 4, A(2)),
         ("m", 10200, 7, A(3)), ("m", 10300, 8, A(3))],
    ])
    j = eager_join_stream(src(spark, folder, "personal"), src(spark, folder, "address"),
                          window_ms=1000)
    run_to_end(j, folder, "out")
    got = spark.read.parquet(f"{folder}/out")
    by_key = {}
    for r in got.orderBy("emit_o1", "emit_side", "emit_id", "peer_t").collect():
        by_key.setdefault(r.key, []).append((r.l_id, r.r_id))
    assert by_key["e"] == [(1, None), (1, 2)]
    assert by_key["o"] == [(3, None), (None, 4)]
    assert by_key["m"] == [(5, None), (6, None), (5, 7), (6, 7), (5, 8), (6, 8)]


def test_settled_fixture_cases(spark, mk, folder):
    write_batches(mk, folder, "personal", [
        [("e", 10000, 1, P(1)), ("o", 10000, 3, P(2)), ("m", 10000, 5, P(3)),
         ("m", 10100, 6, P(3))],
        [("z", 500000, 90, P(9))],  # moves the watermark past everything above
    ])
    write_batches(mk, folder, "address", [
        [("e", 11000, 2, A(1)), ("o", 11001, 4, A(2)), ("m", 10200, 7, A(3)),
         ("m", 10300, 8, A(3))],
        [],
    ])
    j = settled_join_stream(src(spark, folder, "personal"), src(spark, folder, "address"),
                            window_ms=1000, grace="1 second")
    run_to_end(j, folder, "out")
    got = spark.read.parquet(f"{folder}/out").where("key != 'z'")
    nf = lambda v: (v is not None, v or 0)  # noqa: E731  nulls first
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.key, []).append((r.l_id, r.r_id))
    for v in by_key.values():
        v.sort(key=lambda p: (nf(p[0]), nf(p[1])))
    assert by_key == {"e": [(1, 2)], "o": [(None, 4), (3, None)],
                      "m": [(5, 7), (5, 8), (6, 7), (6, 8)]}


def test_eager_drops_rows_behind_watermark(spark, mk, folder):
    write_batches(mk, folder, "personal", [[("a", 100000, 1, P(1))], []])
    write_batches(mk, folder, "address", [[], [("a", 10000, 2, A(1))]])
    j = eager_join_stream(src(spark, folder, "personal"), src(spark, folder, "address"),
                          window_ms=1000, grace="1 second")
    run_to_end(j, folder, "out")
    assert pairs(spark, f"{folder}/out") == [(1, None)]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("table", ["sink", "state"])
def test_eager_table_restart_equals_batch(spark, folder, table):
    """Four slices; the query stops after two and resumes from its checkpoint."""
    write_event_replay(spark, SF, f"{folder}/all", 4)
    import shutil

    def copy(i):
        for kind in ("personal", "address"):
            shutil.copytree(f"{folder}/all/{kind}/part-{i:04d}", f"{folder}/src/{kind}/part-{i:04d}")

    def run():
        q = start_employee_table(
            spark, replay_stream(spark, f"{folder}/src", "personal"),
            replay_stream(spark, f"{folder}/src", "address"), f"{folder}/table",
            name="restart", checkpoint=f"{folder}/ck", trigger={"availableNow": True},
            emit="eager", window_ms=catalog.WINDOW_MS, table=table)
        q.awaitTermination()

    copy(0), copy(1)
    run()
    copy(2), copy(3)
    run()
    got = read_table(spark, f"{folder}/table").drop("key")
    want = catalog._table(spark, SF)
    got = got.select(want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    if table == "state":
        live = read_state_table(spark, f"{folder}/ck").select(want.columns)
        assert live.count() == want.count()
        assert live.exceptAll(want).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("method", ["processor", "native"])
def test_settled_join_equals_batch(spark, folder, method):
    """Native stream-stream outer join; a far-future sentinel per side moves the
    watermark past every real row so all unmatched rows are released."""
    write_event_replay(spark, SF, f"{folder}/src", 3)
    ev = spark.read.parquet(f"{folder}/src/personal/part-*")
    hi = ev.agg(F.max("ts")).first()[0]
    for kind in ("personal", "address"):
        s = spark.read.parquet(f"{folder}/src/{kind}/part-0000").limit(1).select(
            F.lit("__sentinel__").alias("key"),
            (F.lit(hi) + F.expr("INTERVAL 3 DAYS")).alias("ts"), F.lit(-1).cast("long").alias("id"),
            "value")
        s.write.parquet(f"{folder}/src/{kind}/part-0003")
    p = replay_stream(spark, f"{folder}/src", "personal")
    a = replay_stream(spark, f"{folder}/src", "address")
    run_to_end(settled_join_stream(p, a, window_ms=catalog.WINDOW_MS, method=method),
               folder, "out")
    got = spark.read.parquet(f"{folder}/out").where("key != '__sentinel__'").select(
        "l_id", "r_id", "emit_id", "ts")
    bl = conform(read_raw(spark, f"{folder}/src/personal/part-000[0-2]", "personal"),
                 "personal").ok
    br = conform(read_raw(spark, f"{folder}/src/address/part-000[0-2]", "address"),
                 "address").ok
    want = interval_outer_join(bl, br, window_ms=catalog.WINDOW_MS, emit="settled").select(
        "l_id", "r_id", "emit_id", "ts")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_rows_are_kept_after_a_restart_too(spark, mk, folder):
    """Everything that arrived is emitted at its arrival or in quarantine."""
    def start():
        return start_employee_table(
            spark, src(spark, folder, "personal"), src(spark, folder, "address"),
            f"{folder}/table", name="quarantine", checkpoint=f"{folder}/ck", emit="eager",
            trigger={"availableNow": True}, window_ms=1000, grace="1 second",
            quarantine=f"{folder}/late")

    write_batches(mk, folder, "personal", [[("a", 100000, 1, P(1))], [("a", 100500, 3, P(1)),
                                                                     (None, 1, 90, P(9))]])
    write_batches(mk, folder, "address", [[], [("a", 10000, 2, A(1)), ("b", 100600, 7, A(7))]])
    start().awaitTermination()
    late = spark.read.parquet(f"{folder}/late")
    assert [(r.side, r.key, r.id, r.batch) for r in late.collect()] == [(1, "a", 2, 1)]
    assert late.first().r.houseName == A(1)["houseName"] and late.first().l is None

    mk("personal", [("a", 5000, 5, P(1))]).coalesce(1).write.parquet(f"{folder}/personal/part-0002")
    mk("address", [("a", 100700, 4, A(1))]).coalesce(1).write.parquet(f"{folder}/address/part-0002")
    start().awaitTermination()
    late = spark.read.parquet(f"{folder}/late")
    kept = {(r.side, r.id) for r in late.collect()}
    assert kept == {(1, 2), (0, 5)}
    table = read_table(spark, f"{folder}/table")
    assert {(r.empId, r.l_id, r.r_id) for r in table.collect()} == {(1, 3, 4), (7, None, 7)}
    with pytest.raises(ValueError):
        start_employee_table(spark, src(spark, folder, "personal"), src(spark, folder, "address"),
                             f"{folder}/x", emit="settled", quarantine=f"{folder}/y")


def test_a_bucket_has_few_groups_of_state_for_many_keys(spark, mk, folder):
    from keyweave.streaming.join import SLOTS

    n = 3 * SLOTS
    write_batches(mk, folder, "personal", [[(str(i), 1000 + i, i, P(i)) for i in range(n)]])
    write_batches(mk, folder, "address", [[(str(i), 1100 + i, i, A(i)) for i in range(0, n, 2)]])
    p, a = src(spark, folder, "personal"), src(spark, folder, "address")
    run_to_end(eager_join_stream(p, a, window_ms=10**6), folder, "out")
    # pairs of one key only, though keys share a group
    got = pairs(spark, f"{folder}/out")
    assert len(got) == n + n // 2
    assert set(got) == {(i, None) for i in range(n)} | {(i, i) for i in range(0, n, 2)}
    groups = (spark.read.format("statestore").option("operatorId", 0)
              .option("stateVarName", "buffer").load(f"{folder}/ck-out")
              .select("key").distinct().count())
    assert SLOTS / 2 < groups <= 2 * SLOTS
