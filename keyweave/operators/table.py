"""Re-key, last-write-wins table, changelog and look-ups.

The table keeps, per entity key, the latest record in emission order. Each new
record overwrites every field (absent-side nulls and zeros included), so the
table is not a merge: it equals the last changelog row of the key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.timecols import bucket_of
from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.schemas import FULL_FIELDS, field_names

FULL_NAMES = field_names(FULL_FIELDS)


def rekey(df: DataFrame, by: str | Column = "empId", *, keep_source_key: bool = True) -> DataFrame:
    """Replace the message key by column ``by`` (a name, or a Column over the row).

    No explicit repartition: the grouping that follows shuffles on the new key,
    so a repartition here would only add a second exchange.
    """
    cols = [c for c in df.columns if c != "key"]
    src = [F.col("key").alias("source_key")] if keep_source_key else []
    by = F.col(by) if isinstance(by, str) else by
    return df.select(by.alias("key"), *src, *cols)


def changelog(joined_flat: DataFrame, by: str | Column = "empId") -> DataFrame:
    """One table update per joined row, keyed by ``by``, with its emission order.

    A record-at-a-time aggregate forwards every update; because every update
    overwrites all fields, each changelog value equals the joined row itself.
    """
    out = rekey(joined_flat, by)
    return out.where(F.col("key").isNotNull())


def last_write_wins(updates: DataFrame, *, key: str = "key",
                    order: Iterable[str] = tuple(ORDER_COLUMNS),
                    values: Iterable[str] | None = None, keep_order: bool = False) -> DataFrame:
    """Latest value per ``key`` by the tuple ``order``.

    ``keep_order`` also returns the order columns of the winning row (for a
    second fold over several partial tables).

    ``max_by`` is an ordinary aggregate, so Spark combines map-side before the
    shuffle: a key that holds a third of all updates leaves every map task as
    one row.
    """
    order = list(order)
    values = [c for c in (values or updates.columns) if c != key and c not in order]
    if keep_order:
        values += order
    latest = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return (
        updates.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(latest)
        .select(key, *[F.col("_v." + c).alias(c) for c in values])
    )


def collapse_updates(updates: DataFrame, commit_ms: int, *, key: str = "key",
                     order: Iterable[str] = tuple(ORDER_COLUMNS)) -> DataFrame:
    """The changelog as a record cache forwards it: of each key's updates within one commit
    interval (of the emission order's first column, in microseconds) the last.

    Output columns as ``updates``. An ordinary aggregate by key and interval, combined map-side.
    """
    if commit_ms <= 0:
        raise ValueError("commit_ms must be > 0")
    order = list(order)
    values = [c for c in updates.columns if c != key]
    interval = bucket_of(F.col(order[0]), commit_ms * 1000)
    last = updates.where(F.col(key).isNotNull()).groupBy(key, interval.alias("_interval")).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
    return last.select(key, "_v.*").select(*updates.columns)


def lookup_as_of(updates: DataFrame, lookups: DataFrame, *, key: str = "key",
                 lookup_key: str = "empId", at: str = "at", values: Iterable[str],
                 order: Iterable[str] = tuple(ORDER_COLUMNS),
                 chunk_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """``lookups`` with the ``values`` that the table held for their key at their own moment.

    ``at``: the look-up's place in the emission order (microseconds, as the first order column);
    updates emitted up to and at that moment are seen. All values are null where the key had no
    update yet, or is null.

    An as-of join without a sort of a key's whole history: rows are grouped by key and time
    chunk, each chunk's last update is carried to the key's later chunks (one row a chunk), and
    a running last goes on from it inside the chunk. A hot key is as many groups as it has chunks.
    """
    values, order = list(values), list(order)
    v = F.struct(*order, F.struct(*values).alias("values"))
    new = updates.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(order[0]).alias("_o"), F.lit(0).alias("_kind"), v.alias("_v"))
    row = lookups.select(F.struct("*").alias("_row")).schema["_row"].dataType
    asked = lookups.select(
        F.col(lookup_key).cast(new.schema["_key"].dataType).alias("_key"),
        F.col(at).cast("long").alias("_o"), F.lit(1).alias("_kind"),
        F.lit(None).cast(new.schema["_v"].dataType).alias("_v"), F.struct("*").alias("_row"))
    rows = new.withColumn("_row", F.lit(None).cast(row)).union(asked).withColumn(
        "_c", bucket_of(F.col("_o"), chunk_ms * 1000))
    earlier = Window.partitionBy("_key").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.where(F.col("_key").isNotNull()).groupBy("_key", "_c").agg(
        F.max("_v").alias("_last")).select("_key", "_c", F.max("_last").over(earlier).alias("_carry"))
    inside = Window.partitionBy("_key", "_c").orderBy("_o", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(carry, ["_key", "_c"], "left").select(
        "_row", F.greatest(F.max("_v").over(inside), "_carry").alias("_seen"))
    return rows.where(F.col("_row").isNotNull()).select(
        "_row.*", *[F.col("_seen.values." + c).alias(c) for c in values])


def for_entities(left: DataFrame, right: DataFrame, wanted: Callable[[Column], Column], *,
                 by: str = "empId", key: str = "key",
                 max_keys: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows that can matter for the table's entities with ``wanted(entity)``.

    An entity's rows come from right rows with its id, paired with left rows of their message
    keys, and from its left rows alone, which depends on the right rows of their message keys.
    So all rows of a message key stay that has a wanted id on either side, and the others go
    before the join. The table over the result holds every wanted entity as the whole table does;
    other entities in it may be incomplete.

    Up to ``max_keys`` such message keys (counted first) go to the scans as a broadcast filter,
    more by an ordinary semi-join.
    """
    def keys(df: DataFrame) -> DataFrame:
        return df.where(wanted(F.col(by)) & F.col(key).isNotNull()).select(key)

    found = keys(left).union(keys(right)).distinct()
    if found.limit(max_keys + 1).count() <= max_keys:
        found = F.broadcast(found)
    return left.join(found, key, "left_semi"), right.join(found, key, "left_semi")


def lookup(table: DataFrame, keys, *, key: str = "empId", how: str = "left") -> DataFrame:
    """Look up table rows.

    ``keys`` is a DataFrame with a ``key`` column (a batch of look-ups, joined
    on the key; the table has one row per key so the join cannot multiply rows)
    or a small iterable of literal keys (a point or multi-point look-up).
    """
    if isinstance(keys, DataFrame):
        return keys.join(table, on=key, how=how)
    values = list(keys)
    return table.where(F.col(key).isin(values))


def lookup_range(table: DataFrame, lo, hi, *, key: str = "empId") -> DataFrame:
    return table.where(F.col(key).between(lo, hi))
