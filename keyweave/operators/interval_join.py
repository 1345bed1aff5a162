"""Keyed interval outer join of two record streams, in batch.

Semantics (one call = one windowed full outer join on the message key):

* a left row ``l`` and a right row ``r`` match when ``l.key = r.key`` and
  ``|l.ts - r.ts| <= window`` (both ends inclusive); many-to-many;
  the joined row's timestamp is the later of the two;
* rows with a null key (or null timestamp) never join and are never emitted;
* ``emit="eager"``: every arriving row is joined against the rows of the other
  side that arrived **before** it. If it finds none, it is emitted at once with
  the other side absent; a later match does not retract that row;
* ``emit="settled"``: a row is emitted unmatched only if it has no match at all
  (what a watermark-based outer join emits once the window has closed).

Arrival order is ``(o1, side, id)`` (see ``keyweave.functions.order``): event-time
order by default, or an explicit global arrival sequence via ``arrival=``.

Physical plan, chosen to survive hot keys at scale:

* Time buckets two windows wide: every row has a home bucket ``floor(t / 2w)``. The
  right side is copied to the one neighbour its window reaches as well, and the pairs
  come from an inner equi-join on ``(key, bucket)`` with the exact interval as
  residual. Each pair is found exactly once, a hot key is spread over as many shuffle
  groups as it has active windows, the join spills, and AQE can split a skewed group.
* Unmatched rows (event-time order, or settled) are found without an anti-join on
  raw rows: the other side is pre-aggregated map-side to one summary row per
  ``(key, bucket)`` with the first and last times of the bucket's halves and of the
  halves next to it. A half is as wide as the window, so every "is there another-side
  row in my window (that arrived before me)" question is a comparison against that
  row. The probe is a left outer join with one row to a group, so no side of a group
  is held in memory. Pairs and probes read the same two exchanges.
* With an explicit arrival sequence the eager condition is two-dimensional (time
  window and arrival rank): a row is unmatched if the first arrival among the other
  side's rows of its window is after its own. That minimum comes from prefix and suffix
  minima of window-wide blocks (``keyweave.operators.sliding``), one look-up a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.order import arrival_before
from keyweave.functions.timecols import bucket_of, epoch_micros, window_micros
from keyweave.operators.sliding import window_extremes

LEFT, RIGHT = 0, 1
PREFIX = {LEFT: "l_", RIGHT: "r_"}
ORDER_COLUMNS = ["emit_o1", "emit_side", "emit_id", "peer_t", "peer_o1", "peer_id"]


@dataclass(frozen=True)
class _Sides:
    left: DataFrame
    right: DataFrame
    left_cols: list[str]  # value columns of the left input, prefixed
    right_cols: list[str]
    w: int  # window, microseconds
    arrival: bool


def _prepare(df: DataFrame, side: int, key: str, ts: str, id: str, arrival: str | None,
             w: int) -> tuple[DataFrame, list[str]]:
    """Project one side to ``key`` + prefixed columns + internal time/bucket/order."""
    p = PREFIX[side]
    width = max(w, 1)
    t = epoch_micros(df, ts)
    o1 = F.col(arrival).cast("long") if arrival else t
    cols = [c for c in df.columns if c != key]
    if id not in cols or ts not in cols:
        raise ValueError(f"input needs columns {key!r}, {ts!r} and {id!r}")
    out = (
        df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .select(
            F.col(key).alias("key" if side == LEFT else "r__key"),
            *[F.col(c).alias(p + c) for c in cols],
            t.alias(p + "_t"),
            o1.alias(p + "_o1"),
        )
        .withColumn(p + "_b", bucket_of(F.col(p + "_t"), 2 * width))
        # what an inner join would infer, said for every join: their exchanges stay the same
        .where(F.col("key" if side == LEFT else "r__key").isNotNull()
               & F.col(p + "_t").isNotNull() & F.col(p + "_b").isNotNull())
    )
    return out, [p + c for c in cols]


def _sides(left, right, key, ts, id, window_ms, arrival) -> _Sides:
    w = window_micros(window_ms)
    l, lc = _prepare(left, LEFT, key, ts, id, arrival, w)
    r, rc = _prepare(right, RIGHT, key, ts, id, arrival, w)
    return _Sides(l, r, lc, rc, w, arrival is not None)


def _exploded(df: DataFrame, side: int, w: int) -> DataFrame:
    """Copy each row into its home bucket and the neighbour that its window reaches:
    the previous one from a bucket's first half, the next from the second."""
    p = PREFIX[side]
    b, width = F.col(p + "_b"), max(w, 1)
    first_half = F.col(p + "_t") - b * F.lit(2 * width) < F.lit(width)
    return df.withColumn(
        p + "_bt", F.explode(F.array(b, F.when(first_half, b - 1).otherwise(b + 1)))) \
        .where(F.col(p + "_bt").isNotNull()).drop(p + "_b")


def _in_window(t_probe: Column, t_other: Column, w: int) -> Column:
    return (t_other >= t_probe - F.lit(w)) & (t_other <= t_probe + F.lit(w))


def _pos(side: int) -> tuple[Column, Column, Column]:
    p = PREFIX[side]
    return (F.col(p + "_o1"), F.lit(side), F.col(p + "id"))


def _left_first(s: _Sides) -> Column:
    if not s.arrival:
        # (l_t, 0, l_id) < (r_t, 1, r_id)  <=>  l_t <= r_t
        return F.col("l__t") <= F.col("r__t")
    return arrival_before(_pos(LEFT), _pos(RIGHT))


def _pair_exprs(s: _Sides, ts: str, id: str) -> dict[str, Column]:
    """Output columns of a matched pair: the later-arrived row emits it."""
    lf = _left_first(s)

    def later(lc: str, rc: str) -> Column:
        return F.when(lf, F.col(rc)).otherwise(F.col(lc))

    def earlier(lc: str, rc: str) -> Column:
        return F.when(lf, F.col(lc)).otherwise(F.col(rc))

    return {
        "ts": F.greatest(F.col("l_" + ts), F.col("r_" + ts)),
        "emit_o1": later("l__o1", "r__o1"),
        "emit_side": F.when(lf, F.lit(RIGHT)).otherwise(F.lit(LEFT)),
        "emit_id": later("l_" + id, "r_" + id),
        "peer_t": earlier("l__t", "r__t"),
        "peer_o1": earlier("l__o1", "r__o1"),
        "peer_id": earlier("l_" + id, "r_" + id),
    }


def _solo_exprs(side: int, ts: str, id: str) -> dict[str, Column]:
    """Output columns of a row emitted with the other side absent."""
    p = PREFIX[side]
    null = F.lit(None).cast("long")
    return {
        "ts": F.col(p + ts),
        "emit_o1": F.col(p + "_o1"),
        "emit_side": F.lit(side),
        "emit_id": F.col(p + id),
        "peer_t": null,
        "peer_o1": null,
        "peer_id": null,
    }


_EXPR_COLUMNS = ["ts", *ORDER_COLUMNS]


def _pair_condition(s: _Sides) -> Column:
    return (
        (F.col("key") == F.col("r__key"))
        & (F.col("l__b") == F.col("r__bt"))
        & _in_window(F.col("l__t"), F.col("r__t"), s.w)
    )


def _matched(s: _Sides, ts: str, id: str) -> DataFrame:
    m = s.left.join(_exploded(s.right, RIGHT, s.w), _pair_condition(s), "inner")
    e = _pair_exprs(s, ts, id)
    return m.select("key", *s.left_cols, *s.right_cols,
                    *[e[c].alias(c) for c in _EXPR_COLUMNS])


def _summary(other: DataFrame, side: int, emit: str, w: int) -> DataFrame:
    """Per (key, bucket), times of the ``other`` side by half bucket: the last of the half
    before, the first and last of the first half, the first of the second half, and (settled
    only) the first of the half after."""
    p = PREFIX[side]
    key = "key" if side == LEFT else "r__key"
    t, b, width = F.col(p + "_t"), F.col(p + "_b"), max(w, 1)
    first_half = t - b * F.lit(2 * width) < F.lit(width)

    def to(bucket: Column, part: str | Column) -> Column:
        return F.struct(bucket.alias("b"), (F.lit(part) if isinstance(part, str) else part)
                        .alias("part"))

    own = to(b, F.when(first_half, "one").otherwise("two"))
    around = F.when(~first_half, F.array(own, to(b + 1, "before")))
    if emit == "settled":
        around = around.otherwise(F.array(own, to(b - 1, "after")))
    else:
        around = around.otherwise(F.array(own))
    x = other.select(F.col(key).alias("s_key"), t.alias("s_t"), F.explode(around).alias("x"))

    def of(part: str) -> Column:
        return F.when(F.col("x.part") == part, F.col("s_t"))

    aggs = [F.max(of("before")).alias("s_before"), F.min(of("one")).alias("s_one"),
            F.max(of("one")).alias("s_one_last"), F.min(of("two")).alias("s_two")]
    if emit == "settled":
        aggs.append(F.min(of("after")).alias("s_after"))
    return x.groupBy("s_key", F.col("x.b").alias("s_b")).agg(*aggs)


def _found(side: int, emit: str, t: Column, b: Column, w: int) -> Column:
    """Whether a ``side`` row at time ``t`` of bucket ``b`` has a partner that counts, from the
    other side's summary of the bucket (null: none)."""
    width = max(w, 1)
    first_half = t - b * F.lit(2 * width) < F.lit(width)
    w = F.lit(w)
    previous = F.when(first_half, F.col("s_before")).otherwise(F.col("s_one_last"))
    own = F.when(first_half, F.col("s_one")).otherwise(F.col("s_two"))
    near = previous >= t - w
    if emit == "settled":
        following = F.when(first_half, F.col("s_two")).otherwise(F.col("s_after"))
        found = near | own.isNotNull() | (following <= t + w)
    elif side == LEFT:
        # right rows at the same instant arrive after the left row
        found = near | (own < t)
    else:
        found = near | (own <= t)
    return F.coalesce(found, F.lit(False))


def _solos(s: _Sides, side: int, emit: str, rows: DataFrame | None = None) -> DataFrame:
    """The ``side`` rows that the join emits unmatched, decided from the other side's
    summary (event-time order, or settled).

    ``rows``: the right rows copied to buckets, as the pair join takes them; the probe then
    reads that join's exchange again and only the home copies count.
    """
    p = PREFIX[side]
    key = "key" if side == LEFT else "r__key"
    other, other_side = (s.right, RIGHT) if side == LEFT else (s.left, LEFT)
    t, copies = F.col(p + "_t"), rows is not None
    probe = rows if copies else (s.left if side == LEFT else s.right)
    at = p + ("_bt" if copies else "_b")
    summ = _summary(other, other_side, emit, s.w)
    joined = probe.join(summ, (F.col(key) == F.col("s_key")) & (F.col(at) == F.col("s_b")), "left")
    alone = ~_found(side, emit, t, F.col(at), s.w)
    if copies:
        # one condition over both sides' columns, so that it stays above the shared exchange
        home = F.col(at) == bucket_of(t, 2 * max(s.w, 1))
        alone = F.when(F.coalesce("s_b", at) == F.col(at), home & alone).otherwise(False)
    return joined.where(alone).select(*probe.columns)


def _arrival_solos(s: _Sides, side: int) -> DataFrame:
    """Eager unmatched rows under an explicit arrival sequence: those that arrived before every
    other-side row of their window."""
    p, o = PREFIX[side], PREFIX[1 - side]
    probe, other = (s.left, s.right) if side == LEFT else (s.right, s.left)
    key, okey = ("key", "r__key") if side == LEFT else ("r__key", "key")
    first = F.struct(F.col(o + "_o1").alias("o1"), F.col(o + "id").alias("id"))
    rows = window_extremes(probe, other, s.w, {"_first": (first, "min")}, key=key, t=p + "_t",
                           other_key=okey, other_t=o + "_t")
    met = arrival_before((F.col("_first.o1"), F.lit(1 - side), F.col("_first.id")), _pos(side))
    return rows.where(F.col("_first").isNull() | ~met).drop("_first")


def _unmatched(s: _Sides, side: int, emit: str, ts: str, id: str) -> DataFrame:
    if emit == "eager" and s.arrival:
        rows = _arrival_solos(s, side)
    else:
        rows = _solos(s, side, emit)
    return _solo_rows(s, side, rows, ts, id)


def _solo_rows(s: _Sides, side: int, rows: DataFrame, ts: str, id: str) -> DataFrame:
    """Output columns of unmatched rows: the other side's are null."""
    key = "key" if side == LEFT else "r__key"
    other = s.right if side == LEFT else s.left
    null = F.lit(None)
    absent = [null.cast(other.schema[c].dataType).alias(c)
              for c in (s.right_cols if side == LEFT else s.left_cols)]
    present = [F.col(c) for c in (s.left_cols if side == LEFT else s.right_cols)]
    e = _solo_exprs(side, ts, id)
    return rows.select(
        F.col(key).alias("key"),
        *(present + absent if side == LEFT else absent + present),
        *[e[c].alias(c) for c in _EXPR_COLUMNS],
    )


def _parts(s: _Sides, emit: str, ts: str, id: str) -> list[DataFrame]:
    """Pairs and both sides' unmatched rows, over one exchange of each side's rows."""
    copies = _exploded(s.right, RIGHT, s.w)
    m = s.left.join(copies, _pair_condition(s), "inner")
    e = _pair_exprs(s, ts, id)
    pairs = m.select("key", *s.left_cols, *s.right_cols, *[e[c].alias(c) for c in _EXPR_COLUMNS])
    return [pairs, _solo_rows(s, LEFT, _solos(s, LEFT, emit), ts, id),
            _solo_rows(s, RIGHT, _solos(s, RIGHT, emit, copies), ts, id)]


def _check_emit(emit: str) -> None:
    if emit not in ("eager", "settled"):
        raise ValueError("emit must be 'eager' or 'settled'")


def _output(parts: list[DataFrame], s: _Sides) -> DataFrame:
    cols = ["key", "ts", *s.left_cols, *s.right_cols, *ORDER_COLUMNS]
    out = parts[0].select(cols)
    for p in parts[1:]:
        out = out.union(p.select(cols))
    return out


def matched_pairs(left: DataFrame, right: DataFrame, *, key: str = "key", ts: str = "ts",
                  id: str = "id", window_ms: int = 1000, arrival: str | None = None) -> DataFrame:
    """Inner part of the interval join: every (left, right) pair in the window."""
    s = _sides(left, right, key, ts, id, window_ms, arrival)
    return _output([_matched(s, ts, id)], s)


def unmatched_rows(left: DataFrame, right: DataFrame, *, side: str = "left",
                   emit: str = "eager", key: str = "key", ts: str = "ts", id: str = "id",
                   window_ms: int = 1000, arrival: str | None = None) -> DataFrame:
    """Rows of one side that the outer join emits with the other side absent."""
    _check_emit(emit)
    s = _sides(left, right, key, ts, id, window_ms, arrival)
    which = {"left": LEFT, "right": RIGHT}[side]
    return _output([_unmatched(s, which, emit, ts, id)], s)


def interval_outer_join(left: DataFrame, right: DataFrame, *, key: str = "key",
                        ts: str = "ts", id: str = "id", window_ms: int = 1000,
                        emit: str = "eager", arrival: str | None = None) -> DataFrame:
    """Windowed full outer join on ``key``; see the module docstring.

    Output: ``key``, ``ts`` (joined timestamp), ``l_<c>`` for every left column
    but the key, ``r_<c>`` likewise (all null on an absent side), and the emission
    order ``emit_o1, emit_side, emit_id`` (position of the row whose arrival
    produced the output row) with the tie-break ``peer_t, peer_o1, peer_id``
    (the earlier row of a matched pair, null when unmatched). Sorting by
    ``ORDER_COLUMNS`` gives the order in which a record-at-a-time join emits.
    """
    _check_emit(emit)
    s = _sides(left, right, key, ts, id, window_ms, arrival)
    if emit == "eager" and s.arrival:
        parts = [_matched(s, ts, id), _unmatched(s, LEFT, emit, ts, id),
                 _unmatched(s, RIGHT, emit, ts, id)]
    else:
        parts = _parts(s, emit, ts, id)
    return _output(parts, s)


def latest_rows(left: DataFrame, right: DataFrame, *, key: str = "key", ts: str = "ts",
                id: str = "id", window_ms: int = 1000, emit: str = "eager",
                arrival: str | None = None) -> DataFrame:
    """The rows of :func:`interval_outer_join` that can be the last of their entity, when the
    right side's entity id names a joined row's entity: at most one for an input row.

    Of the rows that a right row takes part in, the last emitted is its pair with the left row
    of its window that arrived last, if that one came after it. Otherwise the right row
    itself emits last, and its last pair is with the latest left row of its window (or it is
    alone). Besides these only left rows emitted alone can win, so a last-write-wins table
    needs no other pairs. Both left rows are extremes over the right row's window
    (``keyweave.operators.sliding``); in event-time order they are one and the same.
    """
    _check_emit(emit)
    s = _sides(left, right, key, ts, id, window_ms, arrival)
    own = F.struct(*s.left_cols, "l__t", "l__o1").alias("own")
    time, o1, i = F.col("l__t").alias("t"), F.col("l__o1").alias("o1"), F.col("l_" + id).alias("id")
    best = {"_latest": (F.struct(time, o1, i, own), "max")}
    if s.arrival:
        best["_last"] = (F.struct(o1, i, own), "max")
    w = window_extremes(s.right.drop("r__b"), s.left, s.w, best, key="r__key", t="r__t",
                        other_key="key", other_t="l__t")
    l = F.col("_latest.own")
    if s.arrival:
        after = arrival_before(_pos(RIGHT), (F.col("_last.o1"), F.lit(LEFT), F.col("_last.id")))
        l = F.when(F.col("_last").isNotNull() & after, F.col("_last.own")).otherwise(l)
    w = w.withColumn("_l", l).select(F.col("r__key").alias("key"), "_l.*", *[
        c for c in w.columns if c.startswith("r_") and c != "r__key"])
    pair, pe, se = F.col("l__t").isNotNull(), _pair_exprs(s, ts, id), _solo_exprs(RIGHT, ts, id)
    last = w.select("key", *s.left_cols, *s.right_cols, *[
        F.when(pair, pe[c]).otherwise(se[c]).alias(c) for c in _EXPR_COLUMNS])
    return _output([last, _unmatched(s, LEFT, emit, ts, id)], s)
