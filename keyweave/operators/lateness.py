"""Grace and late rows in batch: the running watermark over the arrival order, and what it drops.

Stream time at a row's arrival is the latest event time among the rows of both streams that arrived
before it; the watermark is that less the grace. A row behind the watermark is late: it joins
nothing, is never emitted and does not count for stream time later on (it could not raise it).
A row at the watermark is in time. Rows without key or timestamp never reach the join and
count for nothing.

The running maximum is a prefix maximum in two levels: arrival order is cut into blocks at
quantiles, the driver turns the blocks' maxima (one number a block) into what came before each, and
a window inside each block does the rest, so no task sees more than a block.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.timecols import epoch_micros
from keyweave.operators.interval_join import LEFT, RIGHT

LEAST = -(2**63)


class OnTime(NamedTuple):
    left: DataFrame  # rows that reach the join, as they came
    right: DataFrame
    late: DataFrame  # key, ts, id, side (0 left, 1 right), watermark (timestamp before the row)


def running_before(rows: DataFrame, value: str, order: list[str], *, blocks: int | None = None,
                   name: str = "before") -> DataFrame:
    """``rows`` with the maximum of the long column ``value`` over all rows before each, by
    ``order`` (its first column a long); null for the first.

    Blocks end at approximate quantiles of that first column; the result does not depend on them.
    """
    spark = rows.sparkSession
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = rows.select(F.col(order[0]).cast("double").alias("o"))
    cuts = sorted({int(x) for x in first.approxQuantile(
        "o", [i / n for i in range(1, n)], 1 / (4 * n))}) if n > 1 else []
    block = _block(F.col(order[0]), cuts)
    peaks = {r.b: r.m for r in rows.groupBy(block.alias("b")).agg(F.max(value).alias("m")).collect()}
    carry, so_far = [], LEAST
    for b in range(len(cuts) + 1):
        carry.append(so_far)
        so_far = max(so_far, LEAST if peaks.get(b) is None else peaks[b])
    inside = Window.partitionBy("_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    came = F.element_at(F.array(*[F.lit(c).cast("long") for c in carry]), F.col("_block") + 1)
    both = F.greatest(F.max(value).over(inside), F.when(came != LEAST, came))
    return rows.withColumn("_block", block).withColumn(name, both).drop("_block")


def _block(x: Column, cuts: list[int], base: int = 0) -> Column:
    """How many of the sorted ``cuts`` are at or below ``x``, by bisection."""
    if not cuts:
        return F.lit(base)
    mid = len(cuts) // 2
    return F.when(x < cuts[mid], _block(x, cuts[:mid], base)).otherwise(
        _block(x, cuts[mid + 1:], base + mid + 1))


def split_late(left: DataFrame, right: DataFrame, *, grace_ms: int, arrival: str | None = None,
               key: str = "key", ts: str = "ts", id: str = "id",
               blocks: int | None = None) -> OnTime:
    """Both streams without their late rows, and these (see the module docstring).

    Rows arrive in the order of column ``arrival`` (event-time order by default, in which
    nothing is late); ties go to the left side, then by id.
    """
    if grace_ms < 0:
        raise ValueError("grace_ms must be >= 0")
    sides = {LEFT: left, RIGHT: right}
    kinds = {s: df.select(F.struct("*").alias("x")).schema["x"].dataType for s, df in sides.items()}

    def tagged(side: int) -> DataFrame:
        df = sides[side]
        t = epoch_micros(df, ts)
        own = [F.struct("*") if s == side else F.lit(None).cast(kinds[s]) for s in (LEFT, RIGHT)]
        return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            (F.col(arrival).cast("long") if arrival else t).alias("o1"), F.lit(side).alias("side"),
            F.col(id).alias("id"), t.alias("t"), own[0].alias("l"), own[1].alias("r"))

    rows = running_before(tagged(LEFT).union(tagged(RIGHT)), "t", ["o1", "side", "id"],
                          blocks=blocks, name="seen")
    mark = F.col("seen") - F.lit(grace_ms * 1000)
    late = F.coalesce(F.col("t") < mark, F.lit(False))
    kept = rows.where(~late)
    of = lambda c: F.coalesce(F.col("l." + c), F.col("r." + c)).alias(c)
    return OnTime(
        kept.where(F.col("side") == LEFT).select("l.*"),
        kept.where(F.col("side") == RIGHT).select("r.*"),
        rows.where(late).select(of(key), of(ts), "id", "side",
                                F.timestamp_micros(mark).alias("watermark")))
