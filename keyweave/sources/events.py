"""Feed the three employee streams from the driver's ``events`` table.

Fixed mapping (one stream per event type):

* personal <- ``view``:    key = user_id as string, empId = user_id, firstName =
  event_type, lastName = props, age = value as float, sex = null
* address  <- ``purchase``: key and empId likewise, houseName = event_type,
  streetName = props, postcode = value as float, other strings null
* vehicle  <- ``click``:   empId = user_id, vehicleNumber = value as float,
  vehicleName = props, insuranceDetails = event_type, manufacturingYear = 2024

Envelope: ``ts`` = event time, ``id`` = event_id (rises with ts).
The value is a struct, as a decoded Kafka record would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.schemas import FIELDS

EVENT_TYPES = {"personal": "view", "address": "purchase", "vehicle": "click"}
# Shift applied to the address empId when message key and empId must differ.
EMPID_SHIFT = 1000000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _value(kind: str, cols: dict[str, Column]) -> Column:
    parts = []
    for name, dtype, _ in FIELDS[kind]:
        c = cols.get(name, F.lit(None))
        parts.append(c.cast(dtype).alias(name))
    return F.struct(*parts)


def raw_stream(ev: DataFrame, kind: str, *, key: Column | None = None,
               empid_shift: int = 0, null_when: dict[str, Column] | None = None,
               empid: Column | None = None, arrival: Column | None = None) -> DataFrame:
    """Envelope + ``value`` struct for one stream kind.

    ``key`` overrides the message key; ``empid_shift`` is added to empId;
    ``null_when`` maps a field to a condition under which that field is null
    (fault injection for the reject path). ``empid`` replaces empId before it is conformed,
    as a producer with a wider type would send it; ``arrival`` adds the arrival sequence ``seq``.
    """
    uid = F.col("user_id")
    emp = (uid + F.lit(empid_shift)).cast("int")
    cols: dict[str, dict[str, Column]] = {
        "personal": {"empId": emp, "firstName": F.col("event_type"),
                     "lastName": F.col("props"), "age": F.col("value")},
        "address": {"empId": emp, "houseName": F.col("event_type"),
                    "streetName": F.col("props"), "postcode": F.col("value")},
        "vehicle": {"empId": emp, "vehicleNumber": F.col("value"),
                    "vehicleName": F.col("props"), "insuranceDetails": F.col("event_type"),
                    "manufacturingYear": F.lit(2024)},
    }
    fields = dict(cols[kind])
    for name, cond in (null_when or {}).items():
        fields[name] = F.when(~cond, fields[name])
    k = key if key is not None else uid.cast("string")
    value = _value(kind, fields)
    if empid is not None:
        value = value.withField("empId", empid)
    return ev.where(F.col("event_type") == EVENT_TYPES[kind]).select(
        k.alias("key"), F.col("ts"), F.col("event_id").alias("id"),
        *([] if arrival is None else [arrival.alias("seq")]), value.alias("value"))


def stream(ev: DataFrame, kind: str, **kw) -> DataFrame:
    """Conformed rows of one stream kind (rejects dropped)."""
    from keyweave.sources.conform import conform

    return conform(raw_stream(ev, kind, **kw), kind).ok
