"""Streaming last-write-wins table, its changelog and a restart-safe table sink.

* :class:`LastWriteWinsProcessor` keeps the latest record per entity key in keyed
  value state (RocksDB) and forwards one update per key and micro-batch — the
  latest of the batch in emission order, like a record cache that collapses
  updates. The live state can be read with ``spark.read.format("statestore")``.
* :class:`TableSink` is a ``foreachBatch`` writer: each micro-batch writes only its
  own latest-per-key rows under ``batch=<id>`` of a plain partitioned parquet folder (a
  retried batch overwrites its own folder, so the sink is idempotent). Nothing is ever
  removed from it. :func:`read_table` folds it with ``max_by`` over ``(batch, emission
  order)``; :func:`write_snapshot` writes that fold to a new path, from which later reads
  start, so that they read only the batches since. Old batches can go by retention.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.operators.table import last_write_wins


class LastWriteWinsProcessor(StatefulProcessor):
    def __init__(self, schema: T.StructType, order: list[str]):
        self.schema = schema
        self.cols = [f.name for f in schema.fields]
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row],
                        timerValues: TimerValues) -> Iterator[Row]:
        # nulls sort first, as in ``max_by`` over the order struct
        last = max(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in self.order))
        self.latest.update(tuple(last[c] for c in self.cols))
        yield Row(**{c: last[c] for c in self.cols})

    def close(self) -> None:
        pass


def last_in_batches(updates: DataFrame, *, key: str = "key",
                    order: list[str] = ORDER_COLUMNS) -> DataFrame:
    """Of each Arrow batch of ``updates`` only the last row of every key, before any shuffle.

    Stateless, so it may stand before a stateful operator of a stream: a key that holds a third
    of all updates leaves each batch as one row. Sorting is Arrow's, with nulls first.
    """
    keys = [(key, "ascending"), *[(c, "ascending") for c in order]]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows > 1:
                t = pa.Table.from_batches([b])
                t = t.take(pc.sort_indices(t, sort_keys=keys, null_placement="at_start"))
                k = t.column(key).combine_chunks()
                same = pc.fill_null(pc.equal(k[1:], k[:-1]), False).to_pylist()
                t = t.filter(pa.array([not s for s in same] + [True]))
                yield from t.combine_chunks().to_batches()
            else:
                yield b

    return updates.where(F.col(key).isNotNull()).mapInArrow(fold, updates.schema)


def lww_stream(updates: DataFrame, *, key: str = "key",
               order: list[str] = ORDER_COLUMNS) -> DataFrame:
    """Stream of table updates (latest per key per micro-batch) from a changelog.

    Updates are folded before the shuffle (:func:`last_in_batches`), so the task of a hot key sees
    one row for each batch of the tasks before it. Sets the session's state store to RocksDB where
    it has the default provider.
    """
    from keyweave.streaming.join import ensure_rocksdb_state

    ensure_rocksdb_state(updates.sparkSession)
    schema = updates.schema
    updates = last_in_batches(updates, key=key, order=order)
    proc = LastWriteWinsProcessor(schema, order)
    return updates.groupBy(key).transformWithState(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode="None")


class TableSink:
    """``foreachBatch`` writer of the update log (see module doc)."""

    def __init__(self, path: str, *, key: str = "key", order: list[str] = ORDER_COLUMNS):
        self.path = path.rstrip("/")
        self.key = key
        self.order = list(order)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # keep the order columns for the fold across batches
        latest = last_write_wins(batch, key=self.key, order=self.order, keep_order=True)
        (latest.write.mode("overwrite")
         .parquet(f"{self.path}/batch={int(batch_id)}"))


class QuarantineSink(TableSink):
    """Update log, and the rows that the eager join dropped as late, kept beside it.

    A micro-batch holds ``update`` rows (the changelog) and ``arrived`` rows (side, key, ts, id and
    the side's columns as ``l`` or ``r``; ids are unique within a side), one struct of each kind or
    null. The eager join emits every row that it takes in, at its arrival; so what arrived in a
    batch and emitted nothing in it was late. Both folders are named by the batch id, so a
    repeated batch overwrites its own, and what arrived is always emitted or in quarantine.
    """

    def __init__(self, path: str, quarantine: str, **kw):
        super().__init__(path, **kw)
        self.quarantine = quarantine.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by both writes; the stateful plan runs once
        try:
            updates = batch.where(F.col("update").isNotNull()).select("update.*")
            super().__call__(updates, batch_id)
            emitted = updates.select(F.col("emit_side").alias("e_side"),
                                     F.col("emit_id").alias("e_id")).distinct()
            arrived = batch.where(F.col("arrived").isNotNull()).select("arrived.*")
            late = arrived.join(emitted, (F.col("side") == F.col("e_side"))
                                & (F.col("id") == F.col("e_id")), "left_anti")
            late.write.mode("overwrite").parquet(f"{self.quarantine}/batch={int(batch_id)}")
        finally:
            batch.unpersist()


def _log(spark: SparkSession, path: str, snapshot: str | None) -> DataFrame:
    """All rows that define the table, each with the ``batch`` it came in."""
    updates = spark.read.parquet(path.rstrip("/"))
    if snapshot is None:
        return updates
    base = spark.read.parquet(snapshot)
    upto = base.agg(F.max("upto_batch")).first()[0]
    if upto is None:
        return updates
    # a pruned read: folders of the snapshot's batches are not opened
    return updates.where(F.col("batch") > upto).unionByName(base.select(updates.columns))


def read_table(spark: SparkSession, path: str, *, key: str = "key",
               order: list[str] = ORDER_COLUMNS, snapshot: str | None = None) -> DataFrame:
    """Current table: the latest update per key over all micro-batches, or over those since
    ``snapshot`` and the snapshot."""
    u = _log(spark, path, snapshot)
    values = [c for c in u.columns if c not in (key, "batch")]
    return last_write_wins(u, key=key, order=["batch", *order],
                           values=values).drop(*[c for c in order if c in values])


def write_snapshot(spark: SparkSession, path: str, out: str, upto_batch: int, *,
                   key: str = "key", order: list[str] = ORDER_COLUMNS,
                   snapshot: str | None = None) -> str:
    """Write the table as of ``upto_batch`` (a committed batch) to the new path ``out``.

    Reads and writes whole folders only: an interrupted call leaves an unfinished ``out``,
    which a repeated one refuses to overwrite, and the table as it was. ``snapshot`` is an
    earlier one to start from.
    """
    u = _log(spark, path, snapshot).where(F.col("batch") <= upto_batch)
    values = [c for c in u.columns if c not in (key, "batch")]
    folded = last_write_wins(u, key=key, order=["batch", *order], values=values, keep_order=True)
    folded.withColumn("upto_batch", F.lit(upto_batch)).write.mode("errorifexists").parquet(out)
    return out


def read_state_table(spark: SparkSession, checkpoint: str, *,
                     state_var: str = "latest") -> DataFrame:
    """The live table held in keyed state by :class:`LastWriteWinsProcessor`
    (``table="state"``), read from the query's checkpoint with the ``statestore``
    source: one row per key as of the last committed micro-batch."""
    held = spark.read.format("state-metadata").load(checkpoint).where(
        F.col("operatorProperties").contains(f'"{state_var}"'))
    op = held.agg(F.min("operatorId")).first()[0]
    if op is not None:
        return (spark.read.format("statestore").option("operatorId", op)
                .option("stateVarName", state_var).load(checkpoint).select("value.*"))
    raise ValueError(f"no operator in {checkpoint} holds state variable {state_var!r}")
