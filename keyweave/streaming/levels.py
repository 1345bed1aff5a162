"""The update log in levels: a table sink whose reads open few folders however long it runs.

Each micro-batch's latest row per key is a run of level 0. When a level holds ``fan_out`` runs,
they are folded into one run of the next level, so the live runs of n batches are at most
``fan_out - 1`` for each of log(n) levels, and a row is rewritten once a level. What is live is said
by the manifest of the last batch, a small JSON file that appears in one rename; there is one
manifest for each batch, so the table can be read as of any batch.

Order of the steps of a batch: its run, the merged runs, the manifest. Nothing is removed and no
live folder is written again, so a stop between any two steps leaves the last manifest and all it
names as they were, and the repeated batch starts over: runs have names of their own, and a
batch that has its manifest is not written twice. What no manifest in use names can go by retention.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.operators.table import last_write_wins


class Manifests:
    """Manifests ``<path>/manifest/<batch>.json`` on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.folder = f"{path.rstrip('/')}/manifest"
        root = self._path(self.folder)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(root)
        self._spark = spark

    def batches(self) -> list[int]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _file(self, batch: int) -> str:
        return f"{self.folder}/{batch:020d}.json"

    def read(self, batch: int) -> list[dict]:
        line = self._spark.read.text(self._file(batch)).first()
        return json.loads(line.value)

    def last(self, upto: int | None = None) -> tuple[int, list[dict]] | None:
        """The last batch (at most ``upto``) and its live runs, oldest first."""
        found = [b for b in self.batches() if upto is None or b <= upto]
        return (found[-1], self.read(found[-1])) if found else None

    def publish(self, batch: int, runs: list[dict]) -> None:
        """One rename; a manifest that is there already stays."""
        draft = self._path(f"{self.folder}/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(runs).encode()))
        out.close()
        if not self._fs.rename(draft, self._path(self._file(batch))) and batch not in self.batches():
            raise OSError(f"manifest of batch {batch} was not published")


class LevelledSink:
    """``foreachBatch`` writer of the levelled log at ``path``."""

    def __init__(self, path: str, *, key: str = "key", order: list[str] = ORDER_COLUMNS,
                 fan_out: int = 4):
        if fan_out < 2:
            raise ValueError("fan_out must be at least 2")
        self.path, self.key, self.order, self.fan_out = path.rstrip("/"), key, list(order), fan_out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        manifests = Manifests(spark, self.path)
        last = manifests.last()
        if last and last[0] >= batch_id:
            return  # a repeated batch whose manifest is out
        runs = list(last[1]) if last else []
        latest = last_write_wins(batch, key=self.key, order=self.order, keep_order=True)
        runs.append(self._write(latest.withColumn("batch", F.lit(int(batch_id)).cast("long")),
                                0, int(batch_id), int(batch_id)))
        while len(runs) >= self.fan_out and len(
                {r["level"] for r in runs[-self.fan_out:]}) == 1:
            runs = runs[:-self.fan_out] + [self._merge(spark, runs[-self.fan_out:])]
        manifests.publish(int(batch_id), runs)

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        folder = f"{self.path}/level={level}/{first}-{last}-{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(folder)
        return {"level": level, "first": first, "last": last, "folder": folder}

    def _merge(self, spark: SparkSession, runs: list[dict]) -> dict:
        folded = last_write_wins(_rows(spark, runs), key=self.key, order=["batch", *self.order],
                                 keep_order=True)
        return self._write(folded, runs[0]["level"] + 1, runs[0]["first"], runs[-1]["last"])


def _rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    parts = [spark.read.parquet(r["folder"]) for r in runs]
    return reduce(lambda a, b: a.unionByName(b), parts)


def live_runs(spark: SparkSession, path: str, *, as_of_batch: int | None = None) -> list[dict]:
    """The runs that make the table (as of a batch), oldest first."""
    last = Manifests(spark, path).last(as_of_batch)
    return last[1] if last else []


def read_levelled(spark: SparkSession, path: str, *, as_of_batch: int | None = None,
                  key: str = "key", order: list[str] = ORDER_COLUMNS) -> DataFrame:
    """The table now, or as it was once ``as_of_batch`` was written."""
    runs = live_runs(spark, path, as_of_batch=as_of_batch)
    if not runs:
        raise ValueError(f"no batch of {path} has a manifest"
                         + ("" if as_of_batch is None else f" up to {as_of_batch}"))
    rows = _rows(spark, runs)
    values = [c for c in rows.columns if c not in (key, "batch", *order)]
    return last_write_wins(rows, key=key, order=["batch", *order], values=values)
