"""keyweave: keyed event-stream joins and a last-write-wins entity table on Spark.

Every operator takes and returns a DataFrame. Batch and Structured Streaming share
the same column layout; the streaming module adds watermarks and keyed state.
"""

from keyweave.operators.flatten import flatten_full_details
from keyweave.operators.interval_join import interval_outer_join, matched_pairs, unmatched_rows
from keyweave.operators.table import changelog, last_write_wins, lookup, lookup_range, rekey
from keyweave.operators.tap import tap, tap_stream
from keyweave.plans.topology import employee_tables
from keyweave.sources.conform import conform

__all__ = [
    "changelog",
    "conform",
    "employee_tables",
    "flatten_full_details",
    "interval_outer_join",
    "last_write_wins",
    "lookup",
    "lookup_range",
    "matched_pairs",
    "rekey",
    "tap",
    "tap_stream",
    "unmatched_rows",
]
# Streaming: keyweave.streaming.topology.start_employee_table (and joined_stream,
# table_updates), keyweave.streaming.join.eager_join_stream / settled_join_stream,
# keyweave.streaming.table.read_table / write_snapshot / read_state_table.
