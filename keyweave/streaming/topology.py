"""The employee topology as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyweave.operators.flatten import flatten_full_details
from keyweave.operators.table import changelog
from keyweave.operators.tap import tap_stream
from keyweave.schemas import DEFAULT_WINDOW_MS
from keyweave.session import checkpoint_location
from keyweave.sources.conform import conform
from keyweave.sources.kafka import kafka_raw
from keyweave.streaming.join import DEFAULT_GRACE, eager_join_stream, settled_join_stream
from keyweave.streaming.table import QuarantineSink, TableSink, lww_stream


def joined_stream(personal: DataFrame, address: DataFrame, *, emit: str = "eager",
                  window_ms: int = DEFAULT_WINDOW_MS, grace: str = DEFAULT_GRACE,
                  arrival: str | None = None, settled_method: str = "native",
                  flatten: Callable[[DataFrame], DataFrame] = flatten_full_details) -> DataFrame:
    """Flattened join rows (message key, emission order), streaming.

    ``settled_method``: ``"native"`` (Spark's stream-stream joins) or ``"processor"``;
    ``flatten``: maps joined rows to records with ``key``, ``ts`` and the order columns."""
    if emit == "eager":
        j = eager_join_stream(personal, address, window_ms=window_ms, grace=grace,
                              arrival=arrival)
    elif emit == "settled":
        j = settled_join_stream(personal, address, window_ms=window_ms, grace=grace,
                                method=settled_method)
    else:
        raise ValueError("emit must be 'eager' or 'settled'")
    return flatten(j)


def table_updates(personal: DataFrame, address: DataFrame, *, table: str = "sink",
                  by: str = "empId", **kw) -> DataFrame:
    """Changelog of the last-write-wins table keyed by ``by`` (``key`` column).

    ``table="sink"``: every joined row, re-keyed; the sink folds them per
    micro-batch with ``max_by`` (JVM-side, map-side combined). ``table="state"``:
    the latest row per key is also kept in keyed state (RocksDB) by
    :class:`~keyweave.streaming.table.LastWriteWinsProcessor`, readable live with
    the ``statestore`` source, at the cost of a Python stateful stage.
    """
    upd = changelog(joined_stream(personal, address, **kw), by)
    if table == "state":
        return lww_stream(upd)
    if table != "sink":
        raise ValueError("table must be 'sink' or 'state'")
    return upd


def start_employee_table(spark: SparkSession, personal: DataFrame, address: DataFrame,
                         table_path: str, *, name: str = "employee_table",
                         checkpoint: str | None = None, trigger: dict | None = None,
                         table: str = "sink", tap: str | None = None,
                         quarantine: str | None = None, **kw) -> StreamingQuery:
    """Run the topology into the update log at ``table_path`` (see ``TableSink``).

    ``tap``: name of an observed metric that counts the personal rows as they pass.
    ``quarantine``: a folder for the rows that the eager join drops as late (``QuarantineSink``).

    The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``; a restart
    with the same checkpoint resumes from the last committed micro-batch.
    """
    if tap:
        personal = tap_stream(personal, tap)
    upd = table_updates(personal, address, table=table, **kw)
    sink = TableSink(table_path)
    if quarantine:
        if table != "sink" or kw.get("emit", "eager") != "eager":
            raise ValueError("quarantine needs emit='eager' and table='sink'")
        upd = _with_arrivals(upd, personal, address)
        sink = QuarantineSink(table_path, quarantine)
    w = (upd.writeStream.queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .foreachBatch(sink))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _with_arrivals(updates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``update`` rows and, past the join, the rows of both sides that reach it (``arrived``)."""
    kinds = [df.select(F.struct("*").alias("x")).schema["x"].dataType for df in (left, right)]

    def arrived(df: DataFrame, side: int) -> DataFrame:
        own = [F.struct("*") if s == side else F.lit(None).cast(kinds[s]) for s in (0, 1)]
        row = F.struct(F.lit(side).alias("side"), "key", "ts", F.col("id").cast("long").alias("id"),
                       own[0].alias("l"), own[1].alias("r"))
        return df.where(F.col("key").isNotNull() & F.col("ts").isNotNull()).select(
            F.lit(None).cast(upd.schema["update"].dataType).alias("update"), row.alias("arrived"))

    upd = updates.select(F.struct("*").alias("update"))
    arrivals = arrived(left, 0).union(arrived(right, 1))
    none = F.lit(None).cast(arrivals.schema["arrived"].dataType)
    return upd.select("update", none.alias("arrived")).union(arrivals)


class KafkaTopology(NamedTuple):
    table: StreamingQuery  # the employee table's query
    vehicle: DataFrame  # conformed vehicle rows, which join nothing
    rejected: dict[str, DataFrame]  # rows that do not conform, by stream


def start_from_kafka(spark: SparkSession, bootstrap: str, table_path: str, *,
                     read: Callable[..., DataFrame] = kafka_raw,
                     options: dict[str, str] | None = None,
                     schema_ids: dict[str, list[int]] | None = None,
                     tap: str | None = "tap_personal", **kw) -> KafkaTopology:
    """From the three topics to the running employee table.

    ``read`` is the source of one stream (tests give the file twin); ``schema_ids`` are the
    accepted registry ids by stream. Other arguments go to :func:`start_employee_table`.
    """
    streams = {
        kind: conform(read(spark, kind, bootstrap, options=options,
                           schema_ids=(schema_ids or {}).get(kind)), kind)
        for kind in ("personal", "address", "vehicle")}
    query = start_employee_table(spark, streams["personal"].ok, streams["address"].ok, table_path,
                                 tap=tap, **kw)
    return KafkaTopology(query, streams["vehicle"].ok,
                         {kind: c.rejected for kind, c in streams.items()})
