"""How many rows the join's state holds: a sweep line over the rows' stay.

A row is held from its event time to the end of its window plus grace, both ends inclusive. Each
row is +1 when it comes and -1 just after it may go; the running sum is what is held. The sum
runs inside each hour and side; over the hours only one number each is carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.timecols import bucket_of, epoch_micros

HOUR = 3_600_000_000


def state_rows(left: DataFrame, right: DataFrame, *, window_ms: int, grace_ms: int,
               key: str = "key", ts: str = "ts", by_micros: int = HOUR) -> DataFrame:
    """side (0 left, 1 right), hour, peak_rows: the most rows held at once in each hour in which a
    row comes or goes. ``by_micros``: the length of an "hour"."""
    stay = F.lit((window_ms + grace_ms) * 1000 + 1)

    def changes(df: DataFrame, side: int) -> DataFrame:
        t = epoch_micros(df, ts)
        return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            F.lit(side).alias("side"), F.explode(F.array(
                F.struct(t.alias("at"), F.lit(1).cast("long").alias("n")),
                F.struct((t + stay).alias("at"), F.lit(-1).cast("long").alias("n")))).alias("x")
        ).select("side", "x.*")

    # all changes of one instant count at once
    at = changes(left, 0).union(changes(right, 1)).groupBy("side", "at").agg(
        F.sum("n").alias("n")).withColumn("h", bucket_of(F.col("at"), by_micros))
    inside = Window.partitionBy("side", "h").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hours = at.withColumn("run", F.sum("n").over(inside)).groupBy("side", "h").agg(
        F.max("run").alias("top"), F.sum("n").alias("net"))
    before = F.coalesce(F.sum("net").over(Window.partitionBy("side").orderBy("h").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # what the hour starts with counts too, if rows only go in it
    return hours.select("side", F.timestamp_micros(F.col("h") * by_micros).alias("hour"),
                        (before + F.greatest(F.col("top"), F.lit(0))).alias("peak_rows"))
