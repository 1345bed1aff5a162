"""Arrival order of joined records.

A row's arrival position is the tuple ``(o1, side, id)``: ``o1`` is the event time
in microseconds when records are processed in event-time order (the default, and
what timestamp-synchronised consumption of in-order topics gives), or an explicit
global arrival sequence. ``side`` is 0 for the left stream and 1 for the right
one, ``id`` the per-stream arrival id. Tuples are unique per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrival_before(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """True when position ``a`` comes strictly before position ``b``."""
    return F.struct(*[x.alias(f"_{i}") for i, x in enumerate(a)]) < F.struct(
        *[x.alias(f"_{i}") for i, x in enumerate(b)]
    )
