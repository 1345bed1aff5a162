"""Kafka source for the three topics, values in schema-registry Avro framing.

Each message value is one magic byte and a 4-byte schema id followed by Avro
binary; the framing is checked and the record decoded in the executors with ``from_avro``
against the fixed writer schema. The key is a UTF-8 string. Reading starts at the earliest
offset; a streaming query resumes from its checkpoint instead.

Needs the ``spark-sql-kafka`` and ``spark-avro`` packages on the classpath; they
are not part of this environment, so this module is built but not exercised here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.schemas import TOPICS, avro_schema_json

# A framed message is a zero byte, a 4-byte schema id and the Avro binary.
MAGIC_BYTE = 0
HEADER_BYTES = 5


def frame_error(value: Column, schema_ids: Iterable[int] | None = None) -> Column:
    """Why a message's framing is not accepted (null: it is, or the message is a tombstone)."""
    magic = F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    error = F.when(F.length(value) <= HEADER_BYTES, F.lit("frame:short")) \
        .when(magic != MAGIC_BYTE, F.lit("frame:magic"))
    if schema_ids is not None:
        error = error.when(~schema_id.isin(*schema_ids),
                           F.concat(F.lit("frame:schema "), schema_id.cast("string")))
    return F.when(value.isNotNull(), error)


def reader_options(kind: str, bootstrap: str, *, topic: str | None = None,
                   options: dict[str, str] | None = None) -> dict[str, str]:
    """Options of the Kafka source: earliest offsets, unless ``options`` say otherwise."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic or TOPICS[kind],
            "startingOffsets": "earliest", **(options or {})}


def kafka_raw(spark: SparkSession, kind: str, bootstrap: str, *, streaming: bool = True,
              topic: str | None = None, options: dict[str, str] | None = None,
              schema_ids: Iterable[int] | None = None) -> DataFrame:
    """Envelope + decoded ``value`` struct + ``decode_error``, ready for :func:`conform`.

    ``schema_ids``: the registry ids whose messages have the fixed writer schema; others are
    not decoded. A message that cannot be decoded has a null value and an error, and ends in
    ``conform(...).rejected``.
    """
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("pyspark avro support is not available") from e
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(
        **reader_options(kind, bootstrap, topic=topic, options=options)).load()
    payload = F.expr(f"substring(value, {HEADER_BYTES + 1})")
    framing = frame_error(F.col("value"), schema_ids)
    record = from_avro(payload, avro_schema_json(kind), {"mode": "PERMISSIVE"})
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("timestamp").alias("ts"),
        # unique per topic: partition in the high bits, offset below
        (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("id"),
        F.when(F.col("value").isNotNull() & framing.isNull(), record).alias("value"),
        framing.alias("decode_error"),
        F.col("value").isNotNull().alias("_sent"),
    ).select("key", "ts", "id", "value", F.when(
        F.col("_sent") & F.col("value").isNull(),
        F.coalesce("decode_error", F.lit("avro"))).alias("decode_error"))
