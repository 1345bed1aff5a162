"""Flatten a joined (personal, address) pair into one full-details record.

A new record starts from defaults (int 0, float 0.0, string null). The personal
side writes its five fields when present, then the address side writes its eight
when present, so the address ``empId`` wins when both sides are there. The
vehicle fields are never written and keep their defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.schemas import FULL_FIELDS, field_names


def default_value(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit(None).cast(dtype)
    return F.lit(0).cast(dtype)


def flatten_full_details(joined: DataFrame, *, left_fields=("personal",),
                         right_fields=("address",), left_id: str = "l_id",
                         right_id: str = "r_id",
                         keep: list[str] | None = None) -> DataFrame:
    """Map ``l_*`` / ``r_*`` columns of an interval join to the full record.

    Output: ``key``, ``ts``, the full-record fields in schema order, ``l_id``,
    ``r_id`` and the emission-order columns (or ``keep`` instead of the last three
    groups).
    """
    from keyweave.schemas import FIELDS

    lnames = {n for kind in left_fields for n in field_names(FIELDS[kind])}
    rnames = {n for kind in right_fields for n in field_names(FIELDS[kind])}
    lp, rp = F.col(left_id).isNotNull(), F.col(right_id).isNotNull()
    out = []
    for name, dtype, _ in FULL_FIELDS:
        v = default_value(dtype)
        # later writers override earlier ones: build from the last writer outward
        if name in rnames:
            v = F.when(rp, F.col("r_" + name)).otherwise(
                F.when(lp, F.col("l_" + name)).otherwise(default_value(dtype))
                if name in lnames else default_value(dtype))
        elif name in lnames:
            v = F.when(lp, F.col("l_" + name)).otherwise(default_value(dtype))
        out.append(v.cast(dtype).alias(name))
    keep = keep if keep is not None else [left_id, right_id, *ORDER_COLUMNS]
    return joined.select("key", "ts", *out, *keep)


def floats_as_double(df: DataFrame) -> DataFrame:
    """Widen float32 columns to double (exactly) for hashing or comparison."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
