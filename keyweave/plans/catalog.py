"""Registered queries: each operator of the join topology on the driver's tables.

Every query reads the whole ``events`` table and maps it to the three employee
streams (``keyweave.sources.events``). Float32 record fields are widened to
double at the edge (exactly), so results hash the same in every engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.flatten import flatten_full_details, floats_as_double
from keyweave.operators.interval_join import (
    interval_outer_join,
    latest_rows,
    matched_pairs,
    unmatched_rows,
)
from keyweave.operators.footprint import state_rows
from keyweave.operators.lateness import OnTime, split_late
from keyweave.operators.table import (
    changelog,
    collapse_updates,
    for_entities,
    last_write_wins,
    lookup,
    lookup_as_of,
    lookup_range,
    rekey,
)
from keyweave.operators.tap import tap
from keyweave.schemas import FULL_FIELDS, field_names
from keyweave.sources.conform import conform
from keyweave.sources.events import EMPID_SHIFT, events, raw_stream, stream

# Join window used by the queries. The reference's own 1000 ms window finds no
# pair in the driver data (events of one user are hours apart), so the join
# queries use 6 hours; ``join_eager_1s`` keeps the reference setting.
WINDOW_MS = 6 * 3600 * 1000
REFERENCE_WINDOW_MS = 1000

# Fault injection, derived from the data (not from ids): producer records with a
# small value carry no message key; personal records with a large value lack age.
NULL_KEY_BELOW = 5.0
NULL_AGE_FROM = 100.0
# Skew: records with a value below this (about a third of each stream) all carry
# one message key, so one key holds a third of all rows over the whole month.
HOT_KEY_BELOW = 20.0
HOT_KEY = "hot"
# A producer's empId beyond the record's 32 bits; microseconds of delay for each unit of value.
WIDE_EMPID = 3_000_000_000
DELAY_MICROS = 100_000_000
# Grace for rows that arrive out of order, and the interval of a record cache's commits.
GRACE_MS = 3600 * 1000
COMMIT_MS = 30 * 60 * 1000
# The changelog's replay, and how many of its slices the table is read as of.
REPLAY_SLICES, AS_OF_SLICE = 10, 7
LATE_SLICES = 6  # micro-batches of the replay in arrival order
# Message framing: the registry id of the writer schema, and one that is not accepted.
SCHEMA_ID, OTHER_SCHEMA_ID = 42, 7
LOOKUP_POINTS = [1, 7, 42, 1_000_000_000]
LOOKUP_RANGE = (10, 60)

FULL = field_names(FULL_FIELDS)


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir)


def _sides(spark, sf_dir, **addr):
    ev = _ev(spark, sf_dir)
    return stream(ev, "personal"), stream(ev, "address", **addr)


def _joined(spark, sf_dir, *, emit="eager", window_ms=WINDOW_MS, **addr) -> DataFrame:
    p, a = _sides(spark, sf_dir, **addr)
    return interval_outer_join(p, a, window_ms=window_ms, emit=emit)


def _flat(spark, sf_dir, **kw) -> DataFrame:
    return flatten_full_details(_joined(spark, sf_dir, **kw))


def _scan(kind: str):
    def q(spark, sf_dir):
        return floats_as_double(stream(_ev(spark, sf_dir), kind))
    return q


# --- sources -----------------------------------------------------------------

def conform_personal(spark, sf_dir):
    raw = raw_stream(_ev(spark, sf_dir), "personal",
                     null_when={"age": F.col("value") >= NULL_AGE_FROM})
    return floats_as_double(conform(raw, "personal").ok)


def conform_rejects(spark, sf_dir):
    raw = raw_stream(_ev(spark, sf_dir), "personal",
                     null_when={"age": F.col("value") >= NULL_AGE_FROM})
    return floats_as_double(conform(raw, "personal").rejected)


def frame_rejects(spark, sf_dir):
    """Personal records as framed messages of producers that get it wrong: without payload, with
    another first byte, with an unknown schema id. What the source's header check says of them."""
    from keyweave.sources.kafka import frame_error

    v = F.col("value")
    schema = F.when(v >= NULL_AGE_FROM, OTHER_SCHEMA_ID).otherwise(SCHEMA_ID)
    head = F.concat(F.when((v >= HOT_KEY_BELOW) & (v < 2 * HOT_KEY_BELOW), "01").otherwise("00"),
                    F.lpad(F.hex(schema), 8, "0"))
    body = F.when(v < NULL_KEY_BELOW, F.lit("")).otherwise(F.hex(F.encode("props", "UTF-8")))
    ev = _ev(spark, sf_dir).where(F.col("event_type") == "view")
    framed = ev.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"),
                       F.unhex(F.concat(head, F.coalesce(body, F.lit("")))).alias("message"))
    return framed.withColumn("decode_error", frame_error(F.col("message"), [SCHEMA_ID])).where(
        F.col("decode_error").isNotNull()).select("key", "id", "decode_error")


def tap_personal(spark, sf_dir):
    out, _ = tap(stream(_ev(spark, sf_dir), "personal"), "tap_personal")
    return floats_as_double(out)


def conform_overflow(spark, sf_dir):
    """Rejects of a producer whose empId is wider than the record's."""
    wide = F.when(F.col("value") >= NULL_AGE_FROM, F.col("user_id") + F.lit(WIDE_EMPID)).otherwise(
        F.col("user_id"))
    raw = raw_stream(_ev(spark, sf_dir), "personal", empid=wide)
    return floats_as_double(conform(raw, "personal").rejected)


def tap_metrics(spark, sf_dir):
    """What the tap on the personal stream counted when its rows passed."""
    out, metrics = tap(stream(_ev(spark, sf_dir), "personal"), "tap_metrics")
    out.write.format("noop").mode("overwrite").save()
    m = metrics.get
    return spark.createDataFrame([(m["rows"], m["max_key"])], "rows long, max_key int")


# --- joins ---------------------------------------------------------------------

def join_matched(spark, sf_dir):
    p, a = _sides(spark, sf_dir)
    return matched_pairs(p, a, window_ms=WINDOW_MS).select(
        "key", "ts", "l_id", "r_id", "l_ts", "r_ts")


def join_eager_left_unmatched(spark, sf_dir):
    p, a = _sides(spark, sf_dir)
    return unmatched_rows(p, a, side="left", emit="eager", window_ms=WINDOW_MS).select(
        "key", "ts", "l_id")


def join_eager_right_unmatched(spark, sf_dir):
    p, a = _sides(spark, sf_dir)
    return unmatched_rows(p, a, side="right", emit="eager", window_ms=WINDOW_MS).select(
        "key", "ts", "r_id")


def join_eager(spark, sf_dir):
    return _joined(spark, sf_dir).select("key", "ts", "l_id", "r_id", "emit_id")


def join_eager_1s(spark, sf_dir):
    return _joined(spark, sf_dir, window_ms=REFERENCE_WINDOW_MS).select(
        "key", "ts", "l_id", "r_id", "emit_id")


def join_settled(spark, sf_dir):
    return _joined(spark, sf_dir, emit="settled").select("key", "ts", "l_id", "r_id")


def join_null_keys(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    nokey = F.when(F.col("value") >= NULL_KEY_BELOW, F.col("user_id").cast("string"))
    p = stream(ev, "personal", key=nokey)
    a = stream(ev, "address", key=nokey)
    return interval_outer_join(p, a, window_ms=WINDOW_MS).select(
        "key", "ts", "l_id", "r_id", "emit_id")


def join_hot_key(spark, sf_dir):
    """The eager join when one message key holds a third of both streams."""
    ev = _ev(spark, sf_dir)
    hot = F.when(F.col("value") < HOT_KEY_BELOW, F.lit(HOT_KEY)).otherwise(
        F.col("user_id").cast("string"))
    p = stream(ev, "personal", key=hot)
    a = stream(ev, "address", key=hot)
    return interval_outer_join(p, a, window_ms=WINDOW_MS).select(
        "key", "ts", "l_id", "r_id", "emit_id")


def _arrival() -> Column:
    """Arrival sequence: the event time plus a delay that the data gives (up to hours)."""
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    return t + F.floor(F.col("value") * DELAY_MICROS).cast("long")


def _arrival_join(spark, sf_dir) -> DataFrame:
    p, a = (stream(_ev(spark, sf_dir), k, arrival=_arrival()) for k in ("personal", "address"))
    return interval_outer_join(p, a, window_ms=WINDOW_MS, arrival="seq")


def join_eager_arrival(spark, sf_dir):
    """The eager join when rows arrive out of event-time order."""
    return _arrival_join(spark, sf_dir).select("key", "ts", "l_id", "r_id", "emit_id")


def emp_table_arrival(spark, sf_dir):
    """The table of that join."""
    p, a = (stream(_ev(spark, sf_dir), k, arrival=_arrival()) for k in ("personal", "address"))
    upd = changelog(flatten_full_details(latest_rows(p, a, window_ms=WINDOW_MS, arrival="seq")))
    t = last_write_wins(upd, values=[*FULL[1:], "l_id", "r_id"])
    return floats_as_double(t.withColumnRenamed("key", "empId"))


def _on_time(spark, sf_dir) -> OnTime:
    p, a = (stream(_ev(spark, sf_dir), k, arrival=_arrival()) for k in ("personal", "address"))
    return split_late(p, a, grace_ms=GRACE_MS, arrival="seq")


def join_eager_grace(spark, sf_dir):
    """The eager join when rows arrive out of order and late ones are dropped."""
    s = _on_time(spark, sf_dir)
    return interval_outer_join(s.left, s.right, window_ms=WINDOW_MS, arrival="seq").select(
        "key", "ts", "l_id", "r_id", "emit_id")


def late_rows(spark, sf_dir):
    """The rows that the grace period leaves out, with the watermark that they met."""
    return _on_time(spark, sf_dir).late.select(
        "key", "ts", "id", "side", F.unix_micros("watermark").alias("watermark_us"))


def join_state_rows(spark, sf_dir):
    """The most rows that the join holds at once, by side and hour."""
    p, a = _sides(spark, sf_dir)
    return state_rows(p, a, window_ms=WINDOW_MS, grace_ms=GRACE_MS).select(
        "side", F.unix_seconds("hour").alias("hour_s"), "peak_rows")


# --- projection ------------------------------------------------------------------

def flatten_join(spark, sf_dir):
    return floats_as_double(_flat(spark, sf_dir).select("key", "ts", *FULL, "l_id", "r_id"))


def flatten_empid_precedence(spark, sf_dir):
    f = _flat(spark, sf_dir, empid_shift=EMPID_SHIFT)
    return f.select("key", "l_id", "r_id", "empId", "firstName", "houseName")


def flatten_defaults(spark, sf_dir):
    f = _flat(spark, sf_dir).where(F.col("l_id").isNull() | F.col("r_id").isNull())
    return floats_as_double(f.select("key", *FULL, "l_id", "r_id"))


def rekey_emp(spark, sf_dir):
    f = _flat(spark, sf_dir, empid_shift=EMPID_SHIFT)
    return rekey(f, "empId").select(
        F.col("key").alias("empId"), "source_key", "ts", "l_id", "r_id")


# --- table -------------------------------------------------------------------------

def _table(spark, sf_dir, *, emit="eager", window_ms=WINDOW_MS, wanted=None, **addr) -> DataFrame:
    p, a = _sides(spark, sf_dir, **addr)
    if wanted is not None:
        p, a = for_entities(p, a, wanted)
    upd = changelog(flatten_full_details(latest_rows(p, a, window_ms=window_ms, emit=emit)))
    t = last_write_wins(upd, values=[*FULL[1:], "l_id", "r_id"])
    return t.withColumnRenamed("key", "empId")


def emp_changelog(spark, sf_dir):
    upd = changelog(_flat(spark, sf_dir))
    return floats_as_double(upd.select(
        F.col("key").alias("empId"), *FULL[1:], "l_id", "r_id", "emit_id"))


def emp_table(spark, sf_dir):
    return floats_as_double(_table(spark, sf_dir))


def emp_table_settled(spark, sf_dir):
    return floats_as_double(_table(spark, sf_dir, emit="settled"))


def emp_table_shifted(spark, sf_dir):
    """Table when message key and empId differ (address empId shifted)."""
    return floats_as_double(_table(spark, sf_dir, empid_shift=EMPID_SHIFT))


def emp_lookup(spark, sf_dir):
    """Current employee details for every vehicle record (batch look-up)."""
    veh = stream(_ev(spark, sf_dir), "vehicle").select(
        F.col("id").alias("vehicle_id"), "empId")
    t = _table(spark, sf_dir).select(
        "empId", "firstName", "lastName", "age", "houseName", "streetName", "postcode")
    return floats_as_double(lookup(t, veh, key="empId"))


def emp_lookup_point(spark, sf_dir):
    """Point look-ups of a few employees, over the rows that can make them."""
    t = _table(spark, sf_dir, wanted=lambda e: e.isin(LOOKUP_POINTS))
    return floats_as_double(lookup(t, LOOKUP_POINTS))


def emp_lookup_point_shifted(spark, sf_dir):
    """Point look-ups when message key and empId differ (address empId shifted)."""
    points = [p + d for p in LOOKUP_POINTS[:3] for d in (0, EMPID_SHIFT)]
    t = _table(spark, sf_dir, wanted=lambda e: e.isin(points), empid_shift=EMPID_SHIFT)
    return floats_as_double(lookup(t, points))


def emp_lookup_range(spark, sf_dir):
    """Range look-up on the table's key."""
    t = _table(spark, sf_dir, wanted=lambda e: e.between(*LOOKUP_RANGE))
    return floats_as_double(lookup_range(t, *LOOKUP_RANGE))


def emp_lookup_asof(spark, sf_dir):
    """What each vehicle record finds in the table at its own arrival."""
    veh = stream(_ev(spark, sf_dir), "vehicle").select(
        F.col("id").alias("vehicle_id"), "empId",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    found = lookup_as_of(changelog(_flat(spark, sf_dir)), veh, values=[
        "firstName", "lastName", "age", "houseName", "streetName", "postcode", "l_id", "r_id"])
    return floats_as_double(found.drop("at"))


def emp_changelog_cached(spark, sf_dir):
    """The changelog behind a record cache that commits every half hour."""
    upd = collapse_updates(changelog(_flat(spark, sf_dir)), COMMIT_MS)
    return floats_as_double(upd.select(
        F.col("key").alias("empId"), *FULL[1:], "l_id", "r_id", "emit_id"))


# --- streaming ---------------------------------------------------------------------

def stream_emp_table(spark, sf_dir):
    """The table that a stream over the replayed events, stopped and restarted half-way, holds
    in its state (the eager join in keyed state, last write wins in keyed state)."""
    from keyweave.streaming.replay import replayed_table

    t = replayed_table(spark, sf_dir, window_ms=WINDOW_MS)
    return floats_as_double(t.select(*FULL, "l_id", "r_id"))


def stream_late_rows(spark, sf_dir):
    """The rows that come too late for a stream of the events in arrival order, from its
    quarantine: a micro-batch's watermark is that of the batches before it."""
    from keyweave.streaming.replay import replayed_quarantine

    t = F.unix_micros("ts")
    late = replayed_quarantine(
        spark, sf_dir, window_ms=WINDOW_MS, grace=f"{GRACE_MS} milliseconds", slices=LATE_SLICES,
        arrival=t + F.floor(F.col("value") * DELAY_MICROS).cast("long"))
    return late.select("side", "key", "id")


def stream_join_settled(spark, sf_dir):
    """The settled join of the replayed streams, stopped and restarted half-way."""
    from keyweave.streaming.replay import replayed_settled_join

    j = replayed_settled_join(spark, sf_dir, window_ms=WINDOW_MS)
    return j.select("key", F.unix_micros("ts").alias("ts_us"), "l_id", "r_id", "emit_id")


def emp_table_as_of_batch(spark, sf_dir):
    """The table as it was after a micro-batch, from a levelled log that went on after it: the
    changelog streamed in ``REPLAY_SLICES`` slices of event time."""
    from keyweave.streaming.levels import read_levelled
    from keyweave.streaming.replay import replayed_changelog

    upd = changelog(_flat(spark, sf_dir))
    path = replayed_changelog(spark, upd, slices=REPLAY_SLICES)
    t = read_levelled(spark, path, as_of_batch=AS_OF_SLICE - 1)
    return floats_as_double(t.select(*FULL, "l_id", "r_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_personal": _scan("personal"),
    "scan_address": _scan("address"),
    "scan_vehicle": _scan("vehicle"),
    "conform_personal": conform_personal,
    "conform_rejects": conform_rejects,
    "conform_overflow": conform_overflow,
    "frame_rejects": frame_rejects,
    "tap_personal": tap_personal,
    "tap_metrics": tap_metrics,
    "join_matched": join_matched,
    "join_eager_left_unmatched": join_eager_left_unmatched,
    "join_eager_right_unmatched": join_eager_right_unmatched,
    "join_eager": join_eager,
    "join_eager_1s": join_eager_1s,
    "join_eager_arrival": join_eager_arrival,
    "join_eager_grace": join_eager_grace,
    "late_rows": late_rows,
    "join_state_rows": join_state_rows,
    "join_settled": join_settled,
    "join_null_keys": join_null_keys,
    "join_hot_key": join_hot_key,
    "flatten_join": flatten_join,
    "flatten_empid_precedence": flatten_empid_precedence,
    "flatten_defaults": flatten_defaults,
    "rekey_emp": rekey_emp,
    "emp_changelog": emp_changelog,
    "emp_changelog_cached": emp_changelog_cached,
    "emp_table": emp_table,
    "emp_table_settled": emp_table_settled,
    "emp_table_shifted": emp_table_shifted,
    "emp_table_arrival": emp_table_arrival,
    "emp_lookup": emp_lookup,
    "emp_lookup_point": emp_lookup_point,
    "emp_lookup_point_shifted": emp_lookup_point_shifted,
    "emp_lookup_range": emp_lookup_range,
    "emp_lookup_asof": emp_lookup_asof,
    "emp_table_as_of_batch": emp_table_as_of_batch,
    "stream_emp_table": stream_emp_table,
    "stream_join_settled": stream_join_settled,
    "stream_late_rows": stream_late_rows,
}
