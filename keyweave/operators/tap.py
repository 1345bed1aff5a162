"""Tap: observe a stream without changing it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def tap(df: DataFrame, name: str = "tap", key: str = "empId") -> tuple[DataFrame, Observation]:
    """Pass rows through unchanged while counting them and tracking the max key.

    Batch: read ``observation.get`` after an action. Streaming: the metrics are
    reported per micro-batch in ``query.lastProgress['observedMetrics']``.
    """
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(F.col(key)).alias("max_key"))
    return out, obs


def tap_stream(df: DataFrame, name: str = "tap", key: str = "empId") -> DataFrame:
    """Streaming form: named observation, metrics in the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.max(F.col(key)).alias("max_key"))
