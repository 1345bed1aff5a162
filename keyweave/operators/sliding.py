"""Extremes of one stream over a time window around each row of another, in linear work.

For a probe row at time t the window is [t - w, t + w]. Time is cut into blocks as wide as the
window, so a window is the end of one block and the start of the next, cut at the same place: its
maximum is the larger of a suffix maximum of the first and a prefix maximum of the second. A
block's rows are copied into two groups, as the first block of one and the second of the one
before; a probe is in one group and takes both maxima from two running windows there, however
many rows its window holds.

A hot (key, block) is cut into ``slices`` of time: each slice's extremes are combined map-side, a
running extreme over the few slices is carried into each, and the running windows stay inside a
slice, so that the group's rows are as many tasks' work as it has slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.timecols import bucket_of

_AGG = {"max": (F.max, F.greatest), "min": (F.min, F.least)}


def window_extremes(probes: DataFrame, others: DataFrame, w: int,
                    best: dict[str, tuple[Column, str]], *, key: str, t: str, other_key: str,
                    other_t: str, slices: int = 16) -> DataFrame:
    """``probes`` with, for each name of ``best`` ((orderable column over ``others``, "max" or
    "min")), its extreme over the other rows of the same key within ``w`` microseconds.

    ``t`` and ``other_t`` are times in microseconds. Null where the window holds no row; null
    values of the column do not count.
    """
    width = 2 * w + 1
    step = -(-width // slices)
    names = list(best)
    start = F.col(t) - F.lit(w)
    block = bucket_of(F.col(other_t), width)
    # ``first``: whether a row is of the group's first block (its suffix counts) or the second
    others = others.select(
        F.col(other_key).alias("_key"), F.pmod(F.col(other_t), F.lit(width)).alias("_off"),
        F.explode(F.array(F.struct(block.alias("g"), F.lit(True).alias("first")),
                          F.struct((block - 1).alias("g"), F.lit(False).alias("first")))).alias("_at"),
        *[c.alias("_v_" + n) for n, (c, _) in best.items()])
    kinds = {n: others.schema["_v_" + n].dataType for n in names}
    row = probes.select(F.struct("*").alias("_row")).schema["_row"].dataType
    none = F.lit(None)
    asking = probes.select(
        F.col(key).alias("_key"), bucket_of(start, width).alias("_g"),
        F.pmod(start, F.lit(width)).alias("_off"), none.cast("boolean").alias("_first"),
        *[none.cast(kinds[n]).alias("_v_" + n) for n in names], F.struct("*").alias("_row"))
    known = others.select("_key", F.col("_at.g").alias("_g"), "_off",
                          F.col("_at.first").alias("_first"), *["_v_" + n for n in names],
                          none.cast(row).alias("_row"))
    # of rows at one place a probe comes first: its suffix has them, its prefix has not
    rows = asking.union(known).select(
        "*", F.floor(F.col("_off") / F.lit(step)).alias("_slice"),
        (2 * F.col("_off") + F.when(F.col("_row").isNull(), 1).otherwise(0)).alias("_o"))

    group = ["_key", "_g"]
    ahead = Window.partitionBy(*group).orderBy("_slice")
    back = Window.partitionBy(*group).orderBy(F.desc("_slice"))
    earlier = (Window.unboundedPreceding, -1)
    suffix = lambda n: F.when(F.col("_first"), F.col("_v_" + n))
    prefix = lambda n: F.when(~F.col("_first"), F.col("_v_" + n))
    sums, from_later, from_earlier, found = [], [], [], []
    inside = Window.partitionBy(*group, "_slice")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    for n, (_, kind) in best.items():
        agg, pick = _AGG[kind]
        sums += [agg(suffix(n)).alias("_s_" + n), agg(prefix(n)).alias("_p_" + n)]
        from_later.append(agg("_s_" + n).over(back.rowsBetween(*earlier)).alias("_v_" + n))
        from_earlier.append(agg("_p_" + n).over(ahead.rowsBetween(*earlier)).alias("_v_" + n))
        found.append(pick(
            agg(suffix(n)).over(inside.orderBy(F.desc("_o")).rowsBetween(*so_far)),
            agg(prefix(n)).over(inside.orderBy("_o").rowsBetween(*so_far))).alias(n))
    # what other slices hand on stands as a row before (or, for suffixes, behind) all of a slice
    carry = rows.groupBy(*group, "_slice").agg(*sums).select(
        *group, "_slice", F.struct(*from_later, F.lit(True).alias("first"),
                                   F.lit(2 * width + 2).cast("long").alias("o")).alias("later"),
        F.struct(*from_earlier, F.lit(False).alias("first"),
                 F.lit(-1).cast("long").alias("o")).alias("earlier"))
    values = ["_v_" + n for n in names]
    carry = carry.select(*group, "_slice", F.explode(F.array("later", "earlier")).alias("c")).where(
        F.coalesce(*[F.when(F.col("c." + v).isNotNull(), True) for v in values], F.lit(False))).select(
        *group, "_slice", F.col("c.first").alias("_first"), *["c." + v for v in values],
        none.cast(row).alias("_row"), F.col("c.o").alias("_o"))
    rows = rows.select(*group, "_slice", "_first", *values, "_row", "_o").union(carry)
    return rows.select("_row", *found).where(F.col("_row").isNotNull()).select("_row.*", *names)
