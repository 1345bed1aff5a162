"""File sources and sinks for the three streams (the test twin of the topics).

Rows are stored flat or as envelope + ``value`` struct, in parquet or JSON. The
schema is always given, never inferred; ``max_files_per_trigger=1`` makes a replay follow
file order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyweave.schemas import ENVELOPE, FIELDS, struct_type


def raw_schema(kind: str, ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    env = [T.StructField(n, ts_type if n == "ts" else t, True) for n, t, _ in ENVELOPE]
    value = struct_type([(n, t, True) for n, t, _ in FIELDS[kind]])
    return T.StructType(env + [T.StructField("value", value, True)])


def read_raw(spark: SparkSession, path: str, kind: str, *, streaming: bool = False,
             fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    schema = raw_schema(kind)
    if streaming:
        reader = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    return spark.read.schema(schema).format(fmt).load(path)


def replay_bounds(df: DataFrame, ts: str = "ts") -> tuple[int, int]:
    """(min, max) event time in microseconds, for slicing several streams alike."""
    from pyspark.sql import functions as F

    t = F.unix_micros(F.col(ts).cast("timestamp"))
    b = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    return b["lo"], b["hi"]


def write_replay(raw: DataFrame, path: str, slices: int, *, bounds: tuple[int, int],
                 ts: str = "ts", only: Iterable[int] | None = None) -> list[str]:
    """Write raw stream rows as ``slices`` parquet folders in event-time order.

    Folder ``part-<i>`` holds the i-th equal-width time slice of ``bounds`` (use the
    same bounds for every stream of a replay so one trigger covers the same time
    span on each). Rows without an event time or outside the bounds have no slice: they raise.
    ``only``: the slices to write now (default: all). The slicing runs in Spark; no rows pass
    through the driver.

    Test and bench tooling: each slice is one file, because the file source orders
    files by modification time and one file per trigger keeps a micro-batch equal
    to a time slice. For more data, raise ``slices`` (the time span per file), not
    the file size.
    """
    from pyspark.sql import functions as F

    lo, hi = bounds
    width = max((hi - lo) // slices + 1, 1)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    sliced = raw.withColumn("_slice", ((t - F.lit(lo)) / F.lit(width)).cast("int"))
    lost = raw.where(t.isNull() | (t < lo) | (t > hi)).count()
    if lost:
        raise ValueError(f"{lost} rows have no event time within the bounds")
    out = []
    for i in range(slices) if only is None else only:
        p = f"{path.rstrip('/')}/part-{i:04d}"
        sliced.where(F.col("_slice") == i).drop("_slice").coalesce(1).write.mode(
            "overwrite").parquet(p)
        out.append(p)
    return out
