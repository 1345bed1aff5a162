"""Smaller public pieces: look-ups, Avro schemas, framing, files, tap, table, topology slots."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from keyweave.operators.flatten import flatten_full_details
from keyweave.operators.table import last_write_wins, lookup, lookup_range
from keyweave.operators.tap import tap, tap_stream
from keyweave.plans.topology import employee_tables
from keyweave.schemas import FIELDS, TOPICS, avro_schema_json
from keyweave.session import ensure_checkpoint_dir
from keyweave.sources.conform import conform
from keyweave.sources.files import read_raw, replay_bounds, write_replay
from keyweave.sources.kafka import frame_error, reader_options
from keyweave.streaming.table import TableSink, read_table, write_snapshot
from tests.test_fixtures import A, P


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/api-{uuid.uuid4().hex[:8]}"


def test_avro_schema_matches_record_fields():
    for kind in ("personal", "address", "vehicle", "full"):
        s = json.loads(avro_schema_json(kind))
        assert s["type"] == "record"
        names = [f["name"] for f in s["fields"]]
        assert names == [n for n, _, _ in FIELDS[kind]]
        for f, (_, _, nullable) in zip(s["fields"], FIELDS[kind]):
            assert isinstance(f["type"], list) == nullable
    assert len(FIELDS["full"]) == 16


def test_lookup_points_and_range(spark):
    t = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "empId int, name string")
    assert sorted(r.empId for r in lookup(t, [3, 5, 42]).collect()) == [3, 5]
    assert sorted(r.empId for r in lookup_range(t, 2, 4).collect()) == [2, 3, 4]
    keys = spark.createDataFrame([(3,), (42,)], "empId int")
    got = {r.empId: r.name for r in lookup(t, keys).collect()}
    assert got == {3: "n3", 42: None}


def test_json_file_source_with_fixed_schema(spark, mk):
    d = _folder(spark)
    mk("personal", [("a", 10000, 1, P(1)), ("b", 10001, 2, {**P(2), "age": None}),
                    ("c", 10002, 3, None)]).write.json(d)
    c = conform(read_raw(spark, d, "personal", fmt="json"), "personal")
    assert [r.id for r in c.ok.collect()] == [1]
    rej = c.rejected.collect()
    assert [(r.id, r.reason) for r in rej] == [(2, "age")]
    assert c.ok.schema["age"].dataType.simpleString() == "float"


def test_tap_passes_rows_and_counts(spark, mk):
    df = conform(mk("personal", [("a", 10000, 1, P(7)), ("b", 10001, 2, P(3))]),
                 "personal").ok
    out, obs = tap(df, "t1")
    assert out.count() == 2
    assert obs.get == {"rows": 2, "max_key": 7}


def test_tap_stream_reports_metrics(spark, mk):
    d = _folder(spark)
    mk("personal", [("a", 10000, 1, P(7)), ("b", 10001, 2, P(3))]).write.parquet(f"{d}/in")
    s = conform(read_raw(spark, f"{d}/in", "personal", streaming=True,
                        max_files_per_trigger=1), "personal").ok
    q = (tap_stream(s, "tap_personal").writeStream.format("noop")
         .option("checkpointLocation", f"{d}/ck").start())
    q.processAllAvailable()
    # one observation per micro-batch (one input file per trigger)
    m = [p["observedMetrics"]["tap_personal"] for p in q.recentProgress
         if p.get("observedMetrics")]
    q.stop()
    assert sum(x["rows"] for x in m) == 2
    assert max(x["max_key"] for x in m if x["max_key"] is not None) == 7


def _sink(spark):
    d = f"{_folder(spark)}/table"
    order = ["o"]
    sink = TableSink(d, key="k", order=order)

    def table(snapshot=None):
        t = read_table(spark, d, key="k", order=order, snapshot=snapshot)
        return {r.k: r.v for r in t.collect()}

    def add(rows, batch):
        sink(spark.createDataFrame(rows, "k int, o int, v string"), batch)

    return d, order, add, table


def test_table_sink_and_snapshots(spark):
    d, order, add, table = _sink(spark)
    b0 = [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]
    add(b0, 0)
    add(b0, 0)  # a retried batch overwrites its own output
    add([(1, 0, "d"), (3, 5, "e")], 1)
    want = {1: "d", 2: "c", 3: "e"}  # later batches win whatever their order value
    assert table() == want
    one = write_snapshot(spark, d, f"{d}-snap1", 1, key="k", order=order)
    assert table(one) == want
    add([(2, 0, "f")], 2)
    assert table(one) == table() == {1: "d", 2: "f", 3: "e"}
    two = write_snapshot(spark, d, f"{d}-snap2", 2, key="k", order=order, snapshot=one)
    add([(1, 9, "g")], 3)
    assert table(one) == table(two) == table() == {1: "g", 2: "f", 3: "e"}


def test_snapshot_leaves_the_table_and_refuses_to_overwrite(spark):
    d, order, add, table = _sink(spark)
    add([(1, 1, "a"), (2, 1, "b")], 0)
    add([(1, 0, "c")], 1)
    out = write_snapshot(spark, d, f"{d}-snap", 0, key="k", order=order)
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(spark, d, out, 1, key="k", order=order)
    # the snapshot of batch 0 does not hide batch 1, and nothing was removed
    assert table(out) == table() == {1: "c", 2: "b"}


def test_write_replay_raises_on_rows_it_would_lose(spark, mk):
    d = _folder(spark)
    raw = mk("personal", [("a", 10000, 1, P(1)), ("b", 20000, 2, P(2))])
    lo, hi = replay_bounds(raw)
    write_replay(raw, f"{d}/all", 2, bounds=(lo, hi))
    assert spark.read.parquet(f"{d}/all/part-*").count() == 2
    with pytest.raises(ValueError, match="1 rows"):
        write_replay(raw, f"{d}/half", 2, bounds=(lo, hi - 1))
    with pytest.raises(ValueError, match="1 rows"):
        write_replay(raw.withColumn("ts", F.when(F.col("id") == 1, F.col("ts"))), f"{d}/null", 2,
                     bounds=(lo, hi))


def test_frame_errors(spark):
    good = b"\x00\x00\x00\x00\x07" + b"avro"
    rows = [(good,), (b"\x01" + good[1:],), (good[:5],), (b"",), (None,),
            (b"\x00\x00\x00\x00\x08x",)]
    df = spark.createDataFrame(rows, "value binary")
    got = [r[0] for r in df.select(frame_error(F.col("value"), [7])).collect()]
    assert got == [None, "frame:magic", "frame:short", "frame:short", None, "frame:schema 8"]
    assert [r[0] for r in df.select(frame_error(F.col("value"))).collect()][-1] is None


def test_kafka_reader_options():
    o = reader_options("personal", "host:9092", options={"maxOffsetsPerTrigger": "5"})
    assert o["startingOffsets"] == "earliest" and o["subscribe"] == TOPICS["personal"]
    assert o["maxOffsetsPerTrigger"] == "5" and o["kafka.bootstrap.servers"] == "host:9092"


def test_undecoded_and_overflowing_rows_are_rejected(spark, mk):
    raw = mk("personal", [("a", 10000, 1, P(1)), ("b", 10001, 2, None), ("c", 10002, 3, None)])
    raw = raw.withColumn("decode_error", F.when(F.col("id") == 3, F.lit("avro")))
    raw = raw.withColumn("value", F.col("value").withField(
        "empId", F.when(F.col("id") == 1, F.lit(3_000_000_000))))
    raw = raw.withColumn("value", F.when(F.col("id") == 1, F.col("value")))
    c = conform(raw, "personal")
    assert c.ok.count() == 0  # the overflow does not stop the job
    assert {r.id: r.reason for r in c.rejected.collect()} == {1: "overflow:empId", 3: "avro"}


def test_checkpoint_folder_must_be_given_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_topology_slots(spark, mk):
    p = mk("personal", [("a", 10000, 1, P(7)), ("b", 10001, 2, P(3))])
    a = mk("address", [("a", 10100, 3, A(7))])
    v = mk("vehicle", [("a", 10200, 4, {"empId": 7, "vehicleNumber": 1.0,
                                        "manufacturingYear": 2024.0})])
    t = employee_tables(p, a, v, conformed=False, tap="slots")
    assert {(r.empId, r.l_id, r.r_id) for r in t.table.collect()} == {(7, 1, 3), (3, 2, None)}
    assert t.tapped.get["max_key"] == 7 and t.vehicle.count() == 1

    def shifted(joined):
        return flatten_full_details(joined).withColumn("empId", F.col("empId") + 100)

    t = employee_tables(p, a, conformed=False, flatten=shifted)
    assert {r.empId for r in t.table.collect()} == {107, 103}
    t = employee_tables(p, a, conformed=False, by="firstName")
    assert {r.firstName for r in t.table.collect()} == {r.firstName for r in t.joined.collect()
                                                        if r.firstName is not None}


def test_last_write_wins_keeps_order_columns(spark):
    u = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, o int, v string")
    r = last_write_wins(u, key="k", order=["o"], keep_order=True).collect()
    assert [(x.k, x.v, x.o) for x in r] == [(1, "b", 2)]
