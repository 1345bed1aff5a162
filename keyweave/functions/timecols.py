"""Time columns as epoch microseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch of column ``ts``.

    ``timestamp`` columns are instants; ``timestamp_ntz`` columns are read as UTC
    wall-clock time without consulting the session zone, so results do not shift
    with ``spark.sql.session.timeZone`` (and never across a DST change).
    """
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        # built from wall-clock parts: casting to an instant would go through
        # the session zone and pick up its DST offsets
        c = f"`{ts}`"
        return F.expr(
            f"unix_date(cast({c} as date)) * 86400000000L + hour({c}) * 3600000000L"
            f" + minute({c}) * 60000000L + cast(extract(SECOND FROM {c}) * 1000000 as bigint)"
        )
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(ts))
    if isinstance(dtype, T.LongType | T.IntegerType):
        # already epoch milliseconds, as in a Kafka record timestamp
        return F.col(ts).cast("long") * 1000
    raise TypeError(f"column {ts!r} has type {dtype.simpleString()}, not a timestamp")


def window_micros(window_ms: int) -> int:
    if window_ms < 0:
        raise ValueError("window_ms must be >= 0")
    return int(window_ms) * 1000



def bucket_of(x: Column, width: int) -> Column:
    """Floor of ``x / width`` for long ``x``, exact (also below zero).

    The numerator is a multiple of ``width``; both are below 2**53, so the
    double quotient is the exact integer.
    """
    w = F.lit(int(width)).cast("long")
    return ((x - F.pmod(x, w)) / w).cast("long")
