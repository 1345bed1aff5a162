"""Out-of-order arrival: extremes over time windows, late rows, state footprint, look-ups as of a
moment and look-ups without the whole table, each against a plain model."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from keyweave.operators.flatten import flatten_full_details
from keyweave.operators.footprint import state_rows
from keyweave.operators.interval_join import interval_outer_join, latest_rows, unmatched_rows
from keyweave.operators.lateness import running_before, split_late
from keyweave.operators.sliding import window_extremes
from keyweave.operators.table import (
    changelog,
    collapse_updates,
    for_entities,
    last_write_wins,
    lookup_as_of,
    rekey,
)
from keyweave.plans import catalog
from tests.conftest import ms
from tests.test_fixtures import A, P

SIDE = "key string, ts timestamp, id long, seq long"


def side(spark, rows):
    """(key, ms, id[, seq])."""
    return spark.createDataFrame(
        [(k, None if t is None else ms(t), i, *(r or (i,))) for k, t, i, *r in rows], SIDE)


# --- extremes over windows -----------------------------------------------------------

@pytest.mark.parametrize("w,slices", [(0, 1), (3, 4), (10, 16), (1000, 3)])
def test_window_extremes_equal_a_scan(spark, w, slices):
    rng = random.Random(w)
    probes = [(rng.choice("ab"), rng.randint(-60, 60), i) for i in range(150)]
    others = [(rng.choice("abc"), rng.randint(-60, 60), i, rng.choice([None, *range(50)]))
              for i in range(150)]
    got = window_extremes(
        spark.createDataFrame(probes, "k string, t long, i long"),
        spark.createDataFrame(others, "ok string, ot long, oi long, v long"), w,
        {"first": (F.col("v"), "min"), "last": (F.struct("ot", "oi"), "max")},
        key="k", t="t", other_key="ok", other_t="ot", slices=slices)
    assert got.columns == ["k", "t", "i", "first", "last"]
    want = set()
    for k, t, i in probes:
        near = [o for o in others if o[0] == k and abs(o[1] - t) <= w]
        want.add((k, t, i, min((o[3] for o in near if o[3] is not None), default=None),
                  max(((o[1], o[2]) for o in near), default=None)))
    assert {(*r[:4], r[4] and tuple(r[4])) for r in got.collect()} == want


def test_hot_bucket_is_many_groups(spark):
    """A third of all rows in one (key, bucket): the groups of the running windows are slices."""
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(n).select(hot.alias("key"),
                                 F.timestamp_micros((F.col("id") * 7919) % 1_000_000).alias("ts"), "id")
    df = latest_rows(rows, rows, window_ms=1000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("_slice" in x for x in windows)
    t = F.unix_micros("ts")
    groups = rows.where("key = 'hot'").select(F.floor((t - 1_000_000) / 2_000_001).alias("g"),
                                              F.floor(F.pmod(t - 1_000_000, F.lit(2_000_001)) / 125_001)
                                              .alias("s")).groupBy("g", "s").count()
    assert groups.agg(F.max("count")).first()[0] <= n / 3 / 7
    assert df.where("r_id is not null").count() == n  # one row for each right row


def test_unmatched_under_arrival_order_grow_linearly(spark):
    """One (key, bucket), every left row before every right row: no partner counts for the left
    side, and every right row has all left rows in its window."""
    def run(n):
        def rows(first):
            return spark.range(n).select(
                F.lit("k").alias("key"), F.timestamp_micros((F.col("id") * 31) % 900_000).alias("ts"),
                F.col("id"), (F.col("id") + first).alias("seq"))
        t0 = time.perf_counter()
        left = unmatched_rows(rows(0), rows(n), side="left", window_ms=1000, arrival="seq").count()
        right = unmatched_rows(rows(0), rows(n), side="right", window_ms=1000, arrival="seq").count()
        assert (left, right) == (n, 0)
        return time.perf_counter() - t0

    run(1000)
    small, large = run(40_000), run(200_000)  # 4e10 pairs
    assert large < 10 * small + 10


def test_table_under_arrival_order_folds_at_most_its_input(spark):
    rng = random.Random(8)
    n = 400
    seq = rng.sample(range(10 * n), 2 * n)
    left = side(spark, [("k", rng.randint(0, 3000), i, seq[i]) for i in range(n)])
    right = side(spark, [("k", rng.randint(0, 3000), i, seq[n + i]) for i in range(n)])
    last = latest_rows(left, right, window_ms=1000, arrival="seq")
    pairs = interval_outer_join(left, right, window_ms=1000, arrival="seq")
    assert last.count() <= 2 * n < pairs.count()
    order = ["emit_o1", "emit_side", "emit_id", "peer_t", "peer_o1", "peer_id"]
    want = pairs.where("r_id is not null").groupBy("r_id").agg(
        F.max_by("l_id", F.struct(*order)).alias("l_id"))
    got = last.where("r_id is not null").select("r_id", "l_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


# --- late rows -----------------------------------------------------------------------------

def model_late(rows, grace):
    """rows: (side, key, ms, id, seq) -> late (side, id, watermark ms)."""
    seen, out = None, []
    for s, k, t, i, q in sorted(rows, key=lambda r: (r[4], r[0], r[3])):
        if k is None or t is None:
            continue
        if seen is not None and t < seen - grace:
            out.append((s, i, seen - grace))
        seen = t if seen is None else max(seen, t)
    return sorted(out)


@pytest.mark.parametrize("blocks", [1, 2, 7, 40])
def test_late_rows_equal_a_record_at_a_time_model(spark, blocks):
    rng = random.Random(blocks)
    rows = []
    for i in range(400):
        t = rng.randint(0, 20_000)
        rows.append((rng.randrange(2), rng.choice(["a", "b", None]), t if rng.random() < 0.95 else None,
                     i, t + rng.choice([0, 10, 3000, 9000])))  # with ties of seq
    l, r = ([x[1:] for x in rows if x[0] == s] for s in (0, 1))
    got = split_late(side(spark, l), side(spark, r), grace_ms=2000, arrival="seq", blocks=blocks)
    late = model_late(rows, 2000)
    assert late and sorted((x.side, x.id, round(x.watermark.timestamp() * 1000))
                           for x in got.late.collect()) == late
    for s, df in ((0, got.left), (1, got.right)):
        dropped = {i for q, i, _ in late if q == s}
        assert df.columns == ["key", "ts", "id", "seq"]
        assert {x.id for x in df.collect()} == {
            x[3] for x in rows if x[0] == s and x[1] is not None and x[2] is not None} - dropped


def test_nothing_is_late_in_event_time_order_and_empty_sides(spark):
    rows = [("a", t, t) for t in (5, 1, 900, 30, 30)]
    got = split_late(side(spark, rows), side(spark, []), grace_ms=0)
    assert got.late.count() == 0 and got.left.count() == 5 and got.right.count() == 0
    empty = split_late(side(spark, []), side(spark, []), grace_ms=0, arrival="seq")
    assert empty.late.count() == empty.left.count() == 0


def test_a_row_at_the_watermark_is_in_time(spark):
    got = split_late(side(spark, [("a", 5000, 1, 0), ("a", 3000, 2, 1), ("a", 2999, 3, 2)]),
                     side(spark, []), grace_ms=2000, arrival="seq")
    assert [x.id for x in got.late.collect()] == [3]


def test_running_maximum_has_no_one_partition_window(spark):
    rows = spark.range(5000).select(F.col("id").alias("o1"), ((F.col("id") * 7919) % 5000).alias("t"))
    df = running_before(rows, "t", ["o1"], blocks=8)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(_block" in plan
    so_far = None
    for r in df.orderBy("o1").collect():
        assert r.before == so_far
        so_far = r.t if so_far is None else max(so_far, r.t)


# --- state footprint -----------------------------------------------------------------------------

def test_state_rows_equal_a_sweep(spark):
    rng = random.Random(4)
    ls, rs = ([("k", rng.randint(0, 9000), i) for i in range(n)] for n in (60, 30))
    ls += [(None, 5, 99), ("k", None, 98)]
    got = state_rows(side(spark, ls), side(spark, rs), window_ms=700, grace_ms=300,
                     by_micros=500_000)
    want = set()
    for s, rows in ((0, ls), (1, rs)):
        ts = [t * 1000 for k, t, _ in rows if k and t is not None]
        end = 1_000_001
        moments = sorted({m for t in ts for m in (t, t + end)})
        held = lambda m: sum(t <= m < t + end for t in ts)
        for h in {m // 500_000 for m in moments}:
            inside = [held(m) for m in moments if m // 500_000 == h]
            want.add((s, h * 500_000, max([held(h * 500_000 - 1), *inside])))
    assert {(r.side, round(r.hour.timestamp() * 1e6), r.peak_rows) for r in got.collect()} == want


# --- look-ups ---------------------------------------------------------------------------------------

def updates(spark, rows):
    """(key, emit_o1, emit_id, value)."""
    return spark.createDataFrame([(k, o, 0, i, None, None, None, v) for k, o, i, v in rows],
                                 "key int, emit_o1 long, emit_side int, emit_id long, peer_t long, "
                                 "peer_o1 long, peer_id long, v string")


@pytest.mark.parametrize("chunk_ms", [1, 7, 10_000])
def test_lookup_as_of_equals_a_scan(spark, chunk_ms):
    rng = random.Random(chunk_ms)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randint(-20_000, 20_000), i, f"v{i}")
            for i in range(120)]
    asked = [(rng.choice([1, 2, 3, None]), rng.randint(-25_000, 25_000), i) for i in range(120)]
    asked += [(1, rows[0][1], 500), (2, rows[1][1], 501)]  # at the very moment of an update
    got = lookup_as_of(updates(spark, rows), spark.createDataFrame(
        asked, "empId int, at long, q long"), values=["v"], chunk_ms=chunk_ms)
    assert got.columns == ["empId", "at", "q", "v"]
    want = []
    for k, at, q in asked:
        seen = [(o, i, v) for key, o, i, v in rows if key == k and k is not None and o <= at]
        want.append((k, at, q, max(seen)[2] if seen else None))
    key = lambda r: r[2]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_collapsed_updates_are_the_last_of_each_interval(spark):
    rows = [(1, 0, 1, "a"), (1, 999, 2, "b"), (1, 1000, 3, "c"), (1, -1, 4, "d"), (2, 5, 5, "e"),
            (None, 5, 6, "f")]
    got = collapse_updates(updates(spark, rows), 1)
    assert got.columns[0] == "key" and got.columns[-1] == "v"
    assert {(r.key, r.v) for r in got.collect()} == {(1, "b"), (1, "c"), (1, "d"), (2, "e")}
    with pytest.raises(ValueError):
        collapse_updates(updates(spark, rows), 0)


def test_rekey_takes_a_column(spark):
    df = spark.createDataFrame([("a", 7), ("b", 8)], "key string, empId int")
    assert [r.key for r in rekey(df, F.col("empId") * 10).orderBy("key").collect()] == [70, 80]
    assert changelog(df, F.when(F.col("empId") == 7, F.col("empId"))).count() == 1


@pytest.mark.parametrize("max_keys", [0, 10_000], ids=["semi_join", "broadcast"])
def test_entities_of_a_pruned_input_are_whole(mk, max_keys):
    """Message keys and entities are unrelated here."""
    rng = random.Random(max_keys)
    rows = {"personal": [], "address": []}
    for i in range(300):
        kind = rng.choice(["personal", "address"])
        make = P if kind == "personal" else A
        rows[kind].append((f"k{rng.randrange(30)}", rng.randint(0, 4000), i, make(rng.randrange(40))))
    from keyweave.sources.conform import conform

    p, a = (conform(mk(k, rows[k]), k).ok for k in ("personal", "address"))

    def table(p, a):
        upd = changelog(flatten_full_details(latest_rows(p, a, window_ms=500)))
        return last_write_wins(upd, values=["l_id", "r_id", "firstName", "houseName"])

    wanted = lambda e: e.isin(3, 17, 999)
    pl, pa_ = for_entities(p, a, wanted, max_keys=max_keys)
    assert 0 < pl.count() < p.count()
    key = F.col("key")
    got = table(pl, pa_).where(wanted(key)).collect()
    assert got and sorted(got) == sorted(table(p, a).where(wanted(key)).collect())


def test_point_lookup_shuffles_only_rows_of_its_keys(spark):
    """Records written to shuffles by ``emp_lookup_point``, against its sides' rows."""
    sf = "/root/testdata/sf0.01"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        q = catalog.QUERIES["emp_lookup_point"](spark, sf)._jdf.queryExecution()
        q.toRdd().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    written, stack = 0, [q.executedPlan()]
    while stack:
        x = stack.pop()
        if x.nodeName() == "Exchange":
            written += x.metrics().apply("shuffleRecordsWritten").value()
        c = x.children()
        stack += [c.apply(i) for i in range(c.size())]
    ev = spark.read.parquet(f"{sf}/events.parquet").where("event_type in ('view', 'purchase')")
    of_keys = ev.where(F.col("user_id").isin(catalog.LOOKUP_POINTS)).count()
    assert 0 < written <= 20 * of_keys < ev.count()
