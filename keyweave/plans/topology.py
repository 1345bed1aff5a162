"""The employee topology as one composition of the operators (batch).

personal ⟗ address on the message key within the window → flatten into the full
record → re-key by empId → last-write-wins table. The personal stream can be
tapped; the vehicle stream is conformed but joins nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation

from keyweave.operators.flatten import flatten_full_details
from keyweave.operators.interval_join import interval_outer_join, latest_rows
from keyweave.operators.table import FULL_NAMES, changelog, last_write_wins
from keyweave.operators.tap import tap as tap_rows
from keyweave.schemas import DEFAULT_WINDOW_MS
from keyweave.sources.conform import conform


class EmployeeTables(NamedTuple):
    joined: DataFrame  # flattened join rows, message key, emission order
    updates: DataFrame  # changelog keyed by empId
    table: DataFrame  # latest full record per entity key
    vehicle: DataFrame | None = None  # conformed vehicle rows
    tapped: Observation | None = None  # metrics of the tap, once an action has run


def employee_tables(personal: DataFrame, address: DataFrame, vehicle: DataFrame | None = None, *,
                    window_ms: int = DEFAULT_WINDOW_MS, emit: str = "eager",
                    arrival: str | None = None, conformed: bool = True,
                    flatten: Callable[[DataFrame], DataFrame] = flatten_full_details,
                    by: str = "empId", tap: str | None = None) -> EmployeeTables:
    """``personal`` / ``address`` / ``vehicle``: conformed rows (or raw envelope + value rows
    with ``conformed=False``).

    ``flatten`` maps joined rows to records (``key``, ``ts``, fields, ``l_id``, ``r_id`` and the
    order columns) and ``by`` names the entity key. With the defaults the table is built from
    the rows that can win it only (:func:`latest_rows`), else from all joined rows.
    """
    if not conformed:
        personal = conform(personal, "personal").ok
        address = conform(address, "address").ok
        vehicle = None if vehicle is None else conform(vehicle, "vehicle").ok
    tapped = None
    if tap:
        personal, tapped = tap_rows(personal, tap)
    j = interval_outer_join(personal, address, window_ms=window_ms, emit=emit, arrival=arrival)
    flat = flatten(j)
    upd = last = changelog(flat, by)
    if flatten is flatten_full_details and by == "empId":
        last = changelog(flatten(latest_rows(personal, address, window_ms=window_ms, emit=emit,
                                             arrival=arrival)))
    values = [c for c in FULL_NAMES if c != by and c in last.columns]
    table = last_write_wins(last, values=[*values, "l_id", "r_id"]).withColumnRenamed("key", by)
    return EmployeeTables(flat, upd, table, vehicle, tapped)
