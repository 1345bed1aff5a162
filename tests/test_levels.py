"""The levelled update log, and the fold before keyed state."""

from __future__ import annotations

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from keyweave.operators.table import last_write_wins
from keyweave.session import ensure_checkpoint_dir
from keyweave.streaming.levels import LevelledSink, Manifests, live_runs, read_levelled
from keyweave.streaming.table import last_in_batches

SCHEMA = "key int, v string, emit_o1 long, emit_side int, emit_id long, peer_t long, " \
         "peer_o1 long, peer_id long"


@pytest.fixture
def path(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/levels-{uuid.uuid4().hex[:8]}"


def batch_rows(b: int, n: int = 12):
    rng = random.Random(b)
    return [(rng.choice([1, 1, 1, *range(20)]), f"b{b}r{i}", rng.randint(0, 5), 0, i, None, None, None)
            for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def model(batches):
    """key -> value after these batches, the last by (batch, order)."""
    out = {}
    for b in batches:
        for k, v, o, s, i, *_ in sorted(batch_rows(b), key=lambda r: r[2:5]):
            out[k] = v
    return out


def table(df):
    return {r.key: r.v for r in df.collect()}


def test_levels_hold_the_table_as_of_every_batch(spark, path):
    sink, n = LevelledSink(path, fan_out=3), 14
    for b in range(n):
        sink(frame(spark, batch_rows(b)), b)
        runs = live_runs(spark, path)
        assert len(runs) <= 2 * (math.floor(math.log(b + 1, 3)) + 1)
        # the runs cover the batches once, in order
        assert [r["first"] for r in runs] == [0, *[r["last"] + 1 for r in runs[:-1]]]
        assert runs[-1]["last"] == b
    for b in (0, 1, 2, 3, 8, 9, 13):
        assert table(read_levelled(spark, path, as_of_batch=b)) == model(range(b + 1))
    assert table(read_levelled(spark, path)) == model(range(n))
    assert table(read_levelled(spark, path, as_of_batch=99)) == model(range(n))


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["run", "merge", "before_manifest", "draft", "published"])
def test_a_stop_between_any_two_steps_loses_nothing(spark, path, monkeypatch, step):
    """Batch 3 fills level 0 (fan-out 2: also level 1) and is stopped after ``step``; then it is
    repeated, as after a restart."""
    sink = LevelledSink(path, fan_out=2)
    for b in range(3):
        sink(frame(spark, batch_rows(b)), b)
    before = live_runs(spark, path)
    with monkeypatch.context() as m:
        if step in ("run", "merge"):
            write = LevelledSink._write

            def stopped(self, rows, level, first, last):
                out = write(self, rows, level, first, last)
                if (level == 0) == (step == "run"):
                    raise Stop
                return out
            m.setattr(LevelledSink, "_write", stopped)
        elif step == "before_manifest":
            m.setattr(Manifests, "publish", lambda *a: (_ for _ in ()).throw(Stop()))
        else:
            publish = Manifests.publish

            def half(self, batch, runs):
                if step == "draft":
                    out = self._fs.create(self._path(f"{self.folder}/_draft-x"), False)
                    out.write(bytearray(b'[{"level"'))
                    out.close()
                else:
                    publish(self, batch, runs)
                raise Stop
            m.setattr(Manifests, "publish", half)
        with pytest.raises(Stop):
            sink(frame(spark, batch_rows(3)), 3)
    done = 4 if step == "published" else 3
    assert table(read_levelled(spark, path)) == model(range(done))
    if step != "published":
        assert live_runs(spark, path) == before
    sink(frame(spark, batch_rows(3)), 3)
    sink(frame(spark, batch_rows(4)), 4)
    assert table(read_levelled(spark, path)) == model(range(5))
    assert table(read_levelled(spark, path, as_of_batch=3)) == model(range(4))


def test_a_repeated_batch_is_written_once_and_an_empty_one_counts(spark, path):
    sink = LevelledSink(path)
    sink(frame(spark, batch_rows(0)), 0)
    first = live_runs(spark, path)
    sink(frame(spark, batch_rows(7)), 0)  # the engine never gives other rows; the manifest rules
    assert live_runs(spark, path) == first
    sink(frame(spark, []), 1)
    assert table(read_levelled(spark, path)) == model([0])
    assert [r["last"] for r in live_runs(spark, path)] == [0, 1]


def test_nothing_written_yet(spark, path):
    with pytest.raises(ValueError):
        read_levelled(spark, path)
    with pytest.raises(ValueError):
        LevelledSink(path, fan_out=1)


def test_fold_before_the_state_keeps_the_table_and_shrinks_a_hot_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice([7, 7, 1, 2, None]), f"v{i}", rng.randint(0, 9), rng.randrange(2), i,
             rng.choice([None, 1, 2]), rng.choice([None, 1]), rng.choice([None, i])) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folded = last_in_batches(df)
    assert folded.schema.simpleString() == df.schema.simpleString()
    assert table(last_write_wins(folded)) == table(last_write_wins(df))
    # one row a task for the hot key
    assert folded.where("key = 7").count() == 3
    assert folded.groupBy(F.spark_partition_id(), "key").count().where("count > 1").count() == 0
    assert last_in_batches(df.where("key = 99")).count() == 0
