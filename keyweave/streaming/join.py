"""Streaming interval outer join, eager and settled.

Both produce the same columns as the batch ``interval_outer_join`` so the flatten
and table operators apply unchanged. State is kept by time buckets two windows wide, so a
hot key spreads over its active buckets.

* ``settled``: Spark's stream-stream joins. A left outer join of the left rows (in
  their home bucket) with the right rows (copied to the neighbour their window
  reaches) gives the pairs and, once the watermark has passed, the left rows alone;
  the same join the other way round gives the right rows alone. ``method="processor"``
  does it in :class:`IntervalJoinProcessor` instead.
* ``eager``: Spark has no join that emits a row alone at its arrival. The two sides
  are tagged and unioned, grouped and fed to :class:`IntervalJoinProcessor`, which
  keeps a group's rows in keyed list state. A group is a bucket's rows of all message keys of
  one slot (a hash of the key): most keys have a row or two in a bucket, and a group of its
  own for each of them would cost more in calls to the state than the join itself. Each arriving row (in ``(o1, side, id)``
  order within a micro-batch) joins the stored rows of the other side in its window,
  or is emitted alone at once. Groups are dropped whole by event-time timers once the
  watermark (max event time minus the grace period) has passed them.

Rows behind the watermark are dropped and counted: those that Spark drops in
``numRowsDroppedByWatermark`` of the query's progress, those that the processor drops
in the observed metric ``late_rows``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from keyweave.functions.timecols import bucket_of, epoch_micros, window_micros
from keyweave.operators.interval_join import LEFT, ORDER_COLUMNS, PREFIX, RIGHT

DEFAULT_GRACE = "24 hours"
_ORDER_TYPES = {"emit_o1": T.LongType(), "emit_side": T.IntegerType(), "emit_id": T.LongType(),
                "peer_t": T.LongType(), "peer_o1": T.LongType(), "peer_id": T.LongType()}


def _side_columns(df: DataFrame, side: int, key: str) -> list[T.StructField]:
    p = PREFIX[side]
    return [T.StructField(p + f.name, f.dataType, True) for f in df.schema.fields if f.name != key]


def join_output_schema(left: DataFrame, right: DataFrame, key: str = "key",
                       ts: str = "ts") -> T.StructType:
    """Column layout shared with the batch join."""
    return T.StructType(
        [T.StructField("key", T.StringType(), True),
         T.StructField("ts", left.schema[ts].dataType, True),
         *_side_columns(left, LEFT, key), *_side_columns(right, RIGHT, key),
         *[T.StructField(c, _ORDER_TYPES[c], True) for c in ORDER_COLUMNS]]
    )


def _as_micros(fields: list[T.StructField]) -> list[T.StructField]:
    """``timestamp`` fields travel through Python as epoch microseconds (exact, and
    free of the time-zone handling of Python datetimes)."""
    return [T.StructField(f.name, T.LongType(), True) if isinstance(f.dataType, T.TimestampType)
            else f for f in fields]


def tagged_union(left: DataFrame, right: DataFrame, *, key: str = "key", ts: str = "ts",
                 id: str = "id", arrival: str | None = None) -> DataFrame:
    """One stream of both sides: ``key, side, t, o1, aid`` (arrival position), the
    event time ``ts`` (for the watermark) and both sides' prefixed columns, with
    ``timestamp`` value columns as epoch microseconds."""
    lf = _as_micros(_side_columns(left, LEFT, key))
    rf = _as_micros(_side_columns(right, RIGHT, key))

    def value(df: DataFrame, f: T.StructField):
        c = f.name[2:]
        if isinstance(df.schema[c].dataType, T.TimestampType):
            return F.unix_micros(F.col(c)).alias(f.name)
        return F.col(c).alias(f.name)

    def tag(df: DataFrame, side: int) -> DataFrame:
        own = lf if side == LEFT else rf
        other = rf if side == LEFT else lf
        t = epoch_micros(df, ts)
        return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            F.col(key).cast("string").alias("key"),
            F.lit(side).alias("side"),
            t.alias("t"),
            (F.col(arrival).cast("long") if arrival else t).alias("o1"),
            F.col(id).cast("long").alias("aid"),
            F.col(ts).alias("ts"),
            *[value(df, f) for f in own],
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in other],
        )

    cols = ["key", "side", "t", "o1", "aid", "ts", *[f.name for f in lf], *[f.name for f in rf]]
    return tag(left, LEFT).select(cols).unionByName(tag(right, RIGHT).select(cols))


LATE = -1  # emit_side of a dropped row's marker
SLOTS = 256  # groups of message keys in a bucket; fixed for the life of a checkpoint


def _time(entry: tuple) -> tuple:
    return entry[:1]


def _place(entry: tuple) -> tuple:
    return entry[:3]


class IntervalJoinProcessor(StatefulProcessor):
    """Record-at-a-time outer join for the message keys of one ``(slot, time bucket)``, eager
    (unmatched rows at arrival) or settled (unmatched rows when the group closes).

    The group holds, for each key, the rows whose home is its bucket (``home`` true: they probe)
    and copies of the neighbouring bucket's rows that can reach it (they are only
    stored), so every partner of a home row is in the group and each pair is
    produced once, by the home row of the later-arrived side.
    """

    def __init__(self, window_ms: int, width: int, input_schema: T.StructType,
                 output_schema: T.StructType, emit: str = "eager"):
        self.w = window_micros(window_ms)
        self.width = width
        self.settled = emit == "settled"
        # stored rows keep every input column but the watermark and group columns
        self.state_schema = T.StructType(
            [f for f in input_schema.fields if f.name not in ("ts", "g", "slot")])
        self.cols = [f.name for f in self.state_schema.fields]
        self.key_at = self.cols.index("key")
        self.left_cols = [c for c in self.cols if c.startswith("l_")]
        self.right_cols = [c for c in self.cols if c.startswith("r_")]
        self.out_cols = [f.name for f in output_schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", self.state_schema)

    def _load(self, keys: set | None = None) -> dict[str, dict[int, list[tuple]]]:
        """The stored rows (of ``keys`` only) by key and side, as (t, o1, id, row) in that order."""
        bufs = defaultdict(lambda: {LEFT: [], RIGHT: []})
        for tup in self.buf.get():
            if keys is None or tup[self.key_at] in keys:
                r = dict(zip(self.cols, tup))
                bufs[r["key"]][r["side"]].append(self._entry(r))
        for sides in bufs.values():
            for rows in sides.values():
                rows.sort(key=_place)
        return bufs

    @staticmethod
    def _entry(r: dict) -> tuple:
        return (r["t"], r["o1"], r["aid"], r)

    def _near(self, rows: list[tuple], t: int) -> range:
        """Indices of the entries in the window of ``t``."""
        return range(bisect_left(rows, (t - self.w,), key=_time),
                     bisect_right(rows, (t + self.w,), key=_time))

    def _row(self, key, lrec: dict | None, rrec: dict | None, emit: dict,
             peer: dict | None) -> dict:
        out = {"key": key}
        for c in self.left_cols:
            out[c] = lrec[c] if lrec is not None else None
        for c in self.right_cols:
            out[c] = rrec[c] if rrec is not None else None
        out["ts"] = max(r["t"] for r in (lrec, rrec) if r is not None)
        out.update(emit_o1=emit["o1"], emit_side=emit["side"], emit_id=emit["aid"])
        if peer is None:
            out.update(peer_t=None, peer_o1=None, peer_id=None)
        else:
            out.update(peer_t=peer["t"], peer_o1=peer["o1"], peer_id=peer["aid"])
        return out

    def handleInputRows(self, key, rows: Iterator[Row],
                        timerValues: TimerValues) -> Iterator[Row]:
        horizon = self._horizon(key[1])
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        batch = [r.asDict() for r in rows]
        if wm > 0:
            # behind the grace period, or in a closed group: nothing can match any more
            late = [r for r in batch if wm >= horizon or r["t"] < wm]
            for r in late:
                if r["home"]:
                    yield self._late(r["key"], r)
            if wm >= horizon:
                return
            if late:
                batch = [r for r in batch if r["t"] >= wm]
        if not batch:
            return
        batch.sort(key=lambda r: (r["o1"], r["side"], r["aid"]))
        # the buffer is read only when a home row has to probe it
        homes = {r["key"] for r in batch if r["home"]}
        fresh = not self.buf.exists()
        bufs = self._load(homes) if homes and not fresh else \
            defaultdict(lambda: {LEFT: [], RIGHT: []})
        for rec in batch:
            k, side = rec["key"], rec["side"]
            if k not in homes:
                continue
            if rec["home"]:
                other = bufs[k][1 - side]
                near = self._near(other, rec["t"])
                if not near and not self.settled:
                    yield self._out(k, rec, None)
                for i in near:
                    yield self._out(k, rec, other[i][3])
            insort(bufs[k][side], self._entry(rec), key=_place)
        self.buf.appendList([tuple(r[c] for c in self.cols) for r in batch])
        if fresh:
            self.handle.registerTimer(horizon // 1000 + 1)

    def _out(self, key, rec: dict, peer: dict | None) -> Row:
        lrec, rrec = (rec, peer) if rec["side"] == LEFT else (peer, rec)
        o = self._row(key, lrec, rrec, rec, peer)
        return Row(**{c: o[c] for c in self.out_cols})

    def _late(self, key, rec: dict) -> Row:
        """Stands for a dropped row until it is counted."""
        o = dict.fromkeys(self.out_cols)
        o.update(key=key, emit_side=LATE, emit_o1=rec["o1"], emit_id=rec["aid"])
        return Row(**o)

    def _horizon(self, g: int) -> int:
        """Event time after which the group is closed.

        Home rows have ``t < end``. Eager: once they are late, nothing can probe.
        Settled: a window later, when no partner of a home row can still arrive.
        """
        end = (g + 1) * self.width
        return end + self.w if self.settled else end

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if self.settled:
            # home rows with no partner at all leave now, once
            for k, sides in self._load().items():
                for side in (LEFT, RIGHT):
                    for *_, rec in sorted(sides[side], key=lambda e: (e[1], e[2])):
                        if rec["home"] and not self._near(sides[1 - side], rec["t"]):
                            yield self._out(k, rec, None)
        self.buf.clear()

    def close(self) -> None:
        pass


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark) -> None:
    """``transformWithState`` needs the RocksDB state store. Set it when the session
    still has the default provider; a provider chosen by the cluster is kept (and
    Spark reports it if it cannot serve keyed state)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(key, None)
    if not cur or cur.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


def _bucketed_join_stream(left: DataFrame, right: DataFrame, *, window_ms: int, grace: str,
                          key: str, ts: str, id: str, arrival: str | None,
                          emit: str) -> DataFrame:
    """State keyed by ``(slot of the key, bucket)`` with buckets two windows wide: a row is sent
    to its home bucket and, as a stored copy, to the one neighbour its window
    reaches (the previous bucket from the first half, the next from the second).
    A hot key is spread over its active buckets, each group's list only grows by
    appends, and a group is dropped whole when the watermark passes it."""
    ensure_rocksdb_state(left.sparkSession)
    w = window_micros(window_ms)
    width = 2 * max(w, 1)
    t = F.col("t")
    b = bucket_of(t, width)
    nb = F.when(t - b * F.lit(width) < F.lit(w), b - 1).otherwise(b + 1)
    u = tagged_union(left, right, key=key, ts=ts, id=id, arrival=arrival)
    u = (u.withColumn("_g", F.explode(F.array(
            F.struct(b.alias("g"), F.lit(True).alias("home")),
            F.struct(nb.alias("g"), F.lit(False).alias("home")))))
         .select(*u.columns, F.col("_g.g").alias("g"), F.col("_g.home").alias("home"),
                 F.pmod(F.xxhash64("key"), F.lit(SLOTS)).alias("slot"))
         .withWatermark("ts", grace))
    out_schema = join_output_schema(left, right, key, ts)
    py_schema = T.StructType(_as_micros(out_schema.fields))
    proc = IntervalJoinProcessor(window_ms, width, u.schema, py_schema, emit=emit)
    j = u.groupBy("slot", "g").transformWithState(
        statefulProcessor=proc, outputStructType=py_schema, outputMode="Append",
        timeMode="EventTime")
    j = j.observe("late_rows", F.count_if(F.col("emit_side") == LATE).alias("late_rows")) \
        .where(F.col("emit_side") != LATE)
    return j.select(*[
        F.timestamp_micros(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in out_schema.fields])


def eager_join_stream(left: DataFrame, right: DataFrame, *, window_ms: int = 1000,
                      grace: str = DEFAULT_GRACE, key: str = "key", ts: str = "ts",
                      id: str = "id", arrival: str | None = None) -> DataFrame:
    """Streaming eager outer join; ``ts`` must be a ``timestamp`` column.

    Sets the session's state store to RocksDB where it has the default provider, which keyed
    state cannot use; that holds for the session's later queries too.
    """
    return _bucketed_join_stream(left, right, window_ms=window_ms, grace=grace, key=key,
                                 ts=ts, id=id, arrival=arrival, emit="eager")


def settled_join_stream(left: DataFrame, right: DataFrame, *, window_ms: int = 1000,
                        grace: str = DEFAULT_GRACE, key: str = "key", ts: str = "ts",
                        id: str = "id", method: str = "native") -> DataFrame:
    """Streaming settled outer join: pairs at once, unmatched rows once no partner
    can arrive any more.

    ``method="native"`` (default): Spark's stream-stream joins on ``(key, bucket)``.
    ``method="processor"``: :class:`IntervalJoinProcessor` (which also sets the session's
    state store, see :func:`eager_join_stream`).
    """
    if method == "processor":
        return _bucketed_join_stream(left, right, window_ms=window_ms, grace=grace, key=key,
                                     ts=ts, id=id, arrival=None, emit="settled")
    if method != "native":
        raise ValueError("method must be 'native' or 'processor'")
    w = window_micros(window_ms)
    width = 2 * max(w, 1)
    fields = {LEFT: _side_columns(left, LEFT, key), RIGHT: _side_columns(right, RIGHT, key)}

    def tagged(df: DataFrame, side: int) -> DataFrame:
        own, other = fields[side], fields[1 - side]
        return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            F.lit(side).alias("side"), F.col(key).cast("string").alias("k"),
            F.col(ts).alias("at"), epoch_micros(df, ts).alias("t"),
            *[F.col(f.name[2:]).alias(f.name) for f in own],
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in other])

    # one watermark over both sides, so that a side without news does not hold back the other
    both_sides = tagged(left, LEFT).unionByName(tagged(right, RIGHT)).withWatermark("at", grace)

    def rows(side: int, copied: bool) -> DataFrame:
        """One side with its home bucket, or with the neighbour its window reaches as well."""
        p, t = PREFIX[side], F.col("t")
        b = bucket_of(t, width)
        g = b if not copied else F.explode(F.array(
            b, F.when(t - b * F.lit(width) < F.lit(max(w, 1)), b - 1).otherwise(b + 1)))
        # the condition names the event time, so that it stays above the watermark
        own = F.when(F.col("at").isNotNull(), F.col("side") == side)
        return both_sides.where(own).select(
            F.col("k").alias(p + "_key"), F.col("at").alias(p + "_at"), t.alias(p + "_t"),
            *[F.col(f.name) for f in fields[side]], g.alias(p + "_g"))

    interval = F.expr(f"INTERVAL {w} MICROSECONDS")

    def joined(side: int) -> DataFrame:
        """All rows of ``side`` with their partners of the other side, if any."""
        p, o = PREFIX[side], PREFIX[1 - side]
        cond = ((F.col(p + "_key") == F.col(o + "_key")) & (F.col(p + "_g") == F.col(o + "_g"))
                & (F.col(o + "_at") >= F.col(p + "_at") - interval)
                & (F.col(o + "_at") <= F.col(p + "_at") + interval))
        return rows(side, False).join(rows(1 - side, True), cond, "left_outer")

    lf_first = F.col("r__key").isNull() | (F.col("l__t") <= F.col("r__t"))
    emit_left = F.col("r__key").isNull() | (F.col("l__t") > F.col("r__t"))
    both = F.col("r__key").isNotNull()

    def pick(when_left: Column, lc: str, rc: str) -> Column:
        return F.when(when_left, F.col(lc)).otherwise(F.col(rc))

    cols = [F.col(f.name) for side in (LEFT, RIGHT) for f in fields[side]]
    lefts = joined(LEFT).select(
        F.col("l__key").alias("key"),
        F.greatest(F.col("l_" + ts), F.col("r_" + ts)).alias("ts"), *cols,
        pick(emit_left, "l__t", "r__t").alias("emit_o1"),
        F.when(emit_left, F.lit(LEFT)).otherwise(F.lit(RIGHT)).alias("emit_side"),
        pick(emit_left, "l_" + id, "r_" + id).alias("emit_id"),
        F.when(both, pick(lf_first, "l__t", "r__t")).alias("peer_t"),
        F.when(both, pick(lf_first, "l__t", "r__t")).alias("peer_o1"),
        F.when(both, pick(lf_first, "l_" + id, "r_" + id)).alias("peer_id"),
    )
    none = F.lit(None).cast("long")
    rights = joined(RIGHT).where(F.col("l__key").isNull()).select(
        F.col("r__key").alias("key"), F.col("r_" + ts).alias("ts"), *cols,
        F.col("r__t").alias("emit_o1"), F.lit(RIGHT).alias("emit_side"),
        F.col("r_" + id).alias("emit_id"), none.alias("peer_t"), none.alias("peer_o1"),
        none.alias("peer_id"))
    return lefts.union(rights)
