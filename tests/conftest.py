from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyweave.session import local_session  # noqa: E402
from keyweave.sources.files import raw_schema  # noqa: E402

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    yield s


def ms(t: int) -> dt.datetime:
    return EPOCH + dt.timedelta(milliseconds=t)


@pytest.fixture(scope="session")
def mk(spark):
    """Raw stream rows: (key, ts_ms, id, value dict or None[, seq])."""

    def build(kind: str, rows, seq: bool = False):
        from pyspark.sql import types as T

        schema = raw_schema(kind)
        if seq:
            schema = T.StructType(schema.fields + [T.StructField("seq", T.LongType())])
        names = [f.name for f in schema["value"].dataType.fields]
        data = []
        for r in rows:
            key, t, i, val = r[:4]
            v = None if val is None else tuple(val.get(n) for n in names)
            data.append((key, ms(t), i, v, *r[4:]))
        return spark.createDataFrame(data, schema)

    return build
