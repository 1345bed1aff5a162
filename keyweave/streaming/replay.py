"""The ``events`` table replayed as streams: time slices as files, one slice a micro-batch, with a
stop and a restart half-way.

Everything is written under the shared checkpoint folder, in a folder of its own for each replay
(clean them by retention).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyweave.functions.timecols import epoch_micros
from keyweave.session import ensure_checkpoint_dir
from keyweave.sources.conform import conform
from keyweave.sources.events import events, raw_stream
from keyweave.sources.files import read_raw, replay_bounds, write_replay
from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.streaming.join import DEFAULT_GRACE, settled_join_stream
from keyweave.streaming.levels import LevelledSink
from keyweave.streaming.table import read_state_table
from keyweave.streaming.topology import start_employee_table

KINDS = ("personal", "address")
END = "__end__"  # message key of the rows that close a replay; not a key of the data


def _arrivals(ev: DataFrame, arrival: Column | None) -> tuple[DataFrame, str]:
    """``ev`` with the column by which a replay is sliced: ``ts``, or the arrival sequence
    (microseconds) as a timestamp."""
    if arrival is None:
        return ev, "ts"
    return ev.withColumn("_seq", F.timestamp_micros(arrival)), "_seq"


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with wall-clock times as UTC instants, whatever the session's zone."""
    ev = events(spark, sf_dir)
    return ev.withColumn("ts", F.timestamp_micros(epoch_micros(ev, "ts")))


def write_event_replay(spark: SparkSession, sf_dir: str, base: str, slices: int,
                       only: Iterable[int] | None = None, arrival: Column | None = None) -> int:
    """Replay folders ``<base>/<kind>/part-<i>`` (of ``only`` these slices); returns the number
    of input rows written so far. ``arrival``: microseconds over ``events`` by which rows arrive
    (default: event time)."""
    ev, by = _arrivals(_instants(spark, sf_dir), arrival)
    lo, hi = replay_bounds(ev, by)
    n, only = 0, None if only is None else list(only)
    for kind in KINDS:
        raw = raw_stream(ev, kind, arrival=None if arrival is None else F.col(by))
        raw = raw if arrival is None else raw.withColumnRenamed("seq", by)
        write_replay(raw, f"{base}/{kind}", slices, bounds=(lo or 0, hi or 0), ts=by, only=only)
        n += spark.read.parquet(f"{base}/{kind}/part-*").count()
    return n


def write_end(spark: SparkSession, sf_dir: str, base: str, slices: int, after_ms: int) -> None:
    """One more slice: a personal row with key ``END``, ``after_ms`` after the last event."""
    _, hi = replay_bounds(_instants(spark, sf_dir))
    row = read_raw(spark, f"{base}/personal/part-*", "personal").schema
    value = row["value"].dataType
    filled = F.struct(*[F.lit(0 if f.name == "empId" else None if f.dataType.simpleString() == "string"
                              else 0.0).cast(f.dataType).alias(f.name) for f in value.fields])
    end = spark.range(1).select(
        F.lit(END).alias("key"), F.timestamp_micros(F.lit((hi or 0) + after_ms * 1000)).alias("ts"),
        F.lit(-1).cast("long").alias("id"), filled.alias("value"))
    end.coalesce(1).write.mode("overwrite").parquet(f"{base}/personal/part-{slices:04d}")


def replay_stream(spark: SparkSession, base: str, kind: str) -> DataFrame:
    return conform(read_raw(spark, f"{base}/{kind}/part-*", kind, streaming=True,
                            max_files_per_trigger=1), kind).ok


def replay_with_restart(spark: SparkSession, sf_dir: str,
                        start: Callable[[DataFrame, DataFrame, str], StreamingQuery], *,
                        slices: int = 4, end_after_ms: int | None = None,
                        arrival: Column | None = None, state_partitions: int | None = None) -> str:
    """Run ``start(personal, address, folder)`` over the first half of the slices until it stops,
    then again, from its checkpoint, over the rest. Returns the folder.

    ``end_after_ms`` adds a last row that far behind the last event, which moves the watermark.
    The streams run in a session of their own, whose stateful operators have ``state_partitions``
    (default: the cluster's cores), so that the caller's settings stay as they are.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions",
                 str(state_partitions or spark.sparkContext.defaultParallelism))
    for part in (range(slices // 2), range(slices // 2, slices)):
        write_event_replay(spark, sf_dir, f"{base}/src", slices, only=part, arrival=arrival)
        if end_after_ms is not None and part.stop == slices:
            write_end(spark, sf_dir, f"{base}/src", slices, end_after_ms)
        q = start(*[replay_stream(own, f"{base}/src", kind) for kind in KINDS], base)
        q.awaitTermination()
    return base


def replayed_table(spark: SparkSession, sf_dir: str, *, window_ms: int, slices: int = 3) -> DataFrame:
    """The employee table in keyed state after a replay with a restart, read from the checkpoint."""
    def start(personal, address, base):
        return start_employee_table(
            personal.sparkSession, personal, address, f"{base}/table", name="replayed_table",
            checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}, emit="eager",
            window_ms=window_ms, table="state")

    base = replay_with_restart(spark, sf_dir, start, slices=slices)
    return read_state_table(spark, f"{base}/checkpoint")


def replayed_quarantine(spark: SparkSession, sf_dir: str, *, window_ms: int, grace: str,
                        arrival: Column, slices: int = 4) -> DataFrame:
    """The late rows (side, key, ts, id, l, r, batch) that a replay in arrival order, with a
    restart, keeps beside the table."""
    def start(personal, address, base):
        return start_employee_table(
            personal.sparkSession, personal, address, f"{base}/table", name="replayed_quarantine",
            checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}, emit="eager",
            window_ms=window_ms, grace=grace, quarantine=f"{base}/late")

    base = replay_with_restart(spark, sf_dir, start, slices=slices, arrival=arrival)
    return spark.read.parquet(f"{base}/late")


def replayed_settled_join(spark: SparkSession, sf_dir: str, *, window_ms: int,
                          grace: str = DEFAULT_GRACE, grace_ms: int = 24 * 3600 * 1000,
                          slices: int = 3) -> DataFrame:
    """The rows of the settled join after a replay with a restart and an end row that lets all
    unmatched rows go. ``grace_ms`` is ``grace`` in milliseconds."""
    def start(personal, address, base):
        j = settled_join_stream(personal, address, window_ms=window_ms, grace=grace)
        return (j.writeStream.format("parquet").outputMode("append").queryName("replayed_join")
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
                .start(f"{base}/joined"))

    base = replay_with_restart(spark, sf_dir, start, slices=slices,
                               end_after_ms=grace_ms + 4 * window_ms + 1)
    return spark.read.parquet(f"{base}/joined").where(F.col("key") != END)


def replayed_changelog(spark: SparkSession, updates: DataFrame, *, slices: int,
                       order: list[str] = ORDER_COLUMNS, fan_out: int = 4) -> str:
    """Stream ``updates`` (``key``, fields, order columns in microseconds) into a levelled log,
    one time slice of the first order column a micro-batch, and return the log's path."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    timed = updates.withColumn("_at", F.timestamp_micros(order[0]))
    timed.write.parquet(f"{base}/updates")
    timed = spark.read.schema(timed.schema).parquet(f"{base}/updates")
    lo, hi = replay_bounds(timed, "_at")
    write_replay(timed, f"{base}/src", slices, bounds=(lo or 0, hi or 0), ts="_at")
    src = (spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 1)
           .parquet(f"{base}/src/part-*").drop("_at"))
    q = (src.writeStream.option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True)
         .foreachBatch(LevelledSink(f"{base}/table", order=order, fan_out=fan_out)).start())
    q.awaitTermination()
    return f"{base}/table"
