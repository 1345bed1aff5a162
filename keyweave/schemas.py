"""Record schemas of the three input streams and the joined output record.

Fixed values: field names, order, types and nullability below must equal the
reference's Avro record definitions so that rows convert one for one.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

# --- fixed values (Avro records, in declared order) -------------------------
# (name, spark type, nullable)
PERSONAL_FIELDS = [
    ("empId", T.IntegerType(), False),
    ("firstName", T.StringType(), True),
    ("lastName", T.StringType(), True),
    ("age", T.FloatType(), False),
    ("sex", T.StringType(), True),
]
ADDRESS_FIELDS = [
    ("empId", T.IntegerType(), False),
    ("houseName", T.StringType(), True),
    ("streetName", T.StringType(), True),
    ("city", T.StringType(), True),
    ("postcode", T.FloatType(), False),
    ("district", T.StringType(), True),
    ("state", T.StringType(), True),
    ("country", T.StringType(), True),
]
VEHICLE_FIELDS = [
    ("empId", T.IntegerType(), False),
    ("vehicleNumber", T.FloatType(), False),
    ("vehicleName", T.StringType(), True),
    ("insuranceDetails", T.StringType(), True),
    ("manufacturingYear", T.FloatType(), False),
]
RECORD_NAMES = {
    "personal": "EmployeePersonal",
    "address": "EmployeeAddress",
    "vehicle": "EmployeeVehicle",
    "full": "EmpFullDetails",
}
# Topic names the three streams are read from.
TOPICS = {
    "address": "Address-Details",
    "personal": "Personal-Details",
    "vehicle": "Vehicle-Details",
}
# Join window of the reference topology, symmetric, in milliseconds.
DEFAULT_WINDOW_MS = 1000
# ---------------------------------------------------------------------------

# The joined record: personal fields, then address fields without empId, then
# vehicle fields without empId.
FULL_FIELDS = PERSONAL_FIELDS + ADDRESS_FIELDS[1:] + VEHICLE_FIELDS[1:]

FIELDS = {
    "personal": PERSONAL_FIELDS,
    "address": ADDRESS_FIELDS,
    "vehicle": VEHICLE_FIELDS,
    "full": FULL_FIELDS,
}


def struct_type(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def field_names(fields) -> list[str]:
    return [n for n, _, _ in fields]


def required_fields(fields) -> list[str]:
    """Fields that the record schema declares non-nullable."""
    return [n for n, _, nullable in fields if not nullable]


# Envelope columns every stream row carries next to its value fields: the message
# key, the event timestamp and an arrival id (offset, or a replay sequence).
ENVELOPE = [
    ("key", T.StringType(), True),
    ("ts", T.TimestampType(), False),
    ("id", T.LongType(), False),
]


_AVRO_TYPES = {T.IntegerType: "int", T.FloatType: "float", T.StringType: "string"}


def avro_schema_json(kind: str, namespace: str | None = None) -> str:
    """Avro JSON schema of a record, for ``from_avro`` / ``to_avro``.

    Decoding depends only on the field layout; pass the producers' ``namespace``
    when the schema must carry the same full record name (e.g. to register it).
    """
    fields = []
    for name, dtype, nullable in FIELDS[kind]:
        base = _AVRO_TYPES[type(dtype)]
        fields.append({"name": name, "type": ["null", base] if nullable else base})
    schema = {"type": "record", "name": RECORD_NAMES[kind], "fields": fields}
    if namespace:
        schema["namespace"] = namespace
    return json.dumps(schema)
