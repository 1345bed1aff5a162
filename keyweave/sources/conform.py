"""Conform raw stream rows to a record schema.

Input rows carry the envelope (``key``, ``ts``, ``id``) and the decoded record as
a struct column ``value``. A null ``value`` is a tombstone: it is dropped, as a
keyed join drops it. Rows whose value has a null in a field the schema declares
non-nullable are rejected (the record builder would refuse them), and so are values
that do not fit their field's type (``overflow:<field>``) and messages that could not
be decoded (``decode_error``, where the source gives one); the rest are cast to the
schema types and flattened. Other envelope columns (a replay sequence, Kafka partition)
pass through unchanged.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.schemas import FIELDS, required_fields


class Conformed(NamedTuple):
    ok: DataFrame
    rejected: DataFrame


ENVELOPE = ("key", "ts", "id")
ERROR = "decode_error"


def _flat(df: DataFrame, kind: str, value: str) -> DataFrame:
    """Flattened rows with ``reason``: empty, or the fields that keep the row out."""
    fields = FIELDS[kind]
    extra = [c for c in df.columns if c not in (*ENVELOPE, value, ERROR)]
    required = set(required_fields(fields))
    present, reasons = F.col(value).isNotNull(), []
    if ERROR in df.columns:
        present = present | F.col(ERROR).isNotNull()
        reasons.append(F.col(ERROR))
    for n, t, _ in fields:
        v = F.col(f"{value}.{n}")
        if df.schema[value].dataType[n].dataType != t:
            unfit = v.isNotNull() & v.try_cast(t).isNull()
            reasons.append(F.when(F.col(value).isNotNull() & unfit, F.lit(f"overflow:{n}")))
        if n in required:
            reasons.append(F.when(F.col(value).isNotNull() & v.isNull(), F.lit(n)))
    return df.where(present).select(
        F.col("key").cast("string").alias("key"),
        "ts",
        F.col("id").cast("long").alias("id"),
        *extra,
        *[F.col(f"{value}.{n}").try_cast(t).alias(n) for n, t, _ in fields],
        F.concat_ws(",", *reasons).alias("reason"),
    )


def conform(df: DataFrame, kind: str, *, value: str = "value") -> Conformed:
    flat = _flat(df, kind, value)
    return Conformed(ok=flat.where(F.col("reason") == "").drop("reason"),
                     rejected=flat.where(F.col("reason") != ""))
