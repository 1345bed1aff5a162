"""DuckDB SQL for every registered query, written from the semantics directly.

The join is stated the naive way — pairs in the window, and ``NOT EXISTS`` for
unmatched rows with the arrival tuple compared as a row value — so it checks the
Spark plan's bucket summaries rather than repeating them. Floats are widened to
double at the edge, as in the Spark queries.
"""

from __future__ import annotations

from pyspark.sql.types import FloatType

from keyweave.plans.catalog import (
    AS_OF_SLICE,
    COMMIT_MS,
    DELAY_MICROS,
    GRACE_MS,
    HOT_KEY,
    HOT_KEY_BELOW,
    LATE_SLICES,
    LOOKUP_POINTS,
    LOOKUP_RANGE,
    NULL_AGE_FROM,
    NULL_KEY_BELOW,
    OTHER_SCHEMA_ID,
    REFERENCE_WINDOW_MS,
    REPLAY_SLICES,
    WIDE_EMPID,
    WINDOW_MS,
)
from keyweave.schemas import FIELDS, FULL_FIELDS, field_names
from keyweave.sources.events import EMPID_SHIFT

P_FIELDS, A_FIELDS, V_FIELDS = (field_names(FIELDS[k]) for k in ("personal", "address", "vehicle"))
FULL = field_names(FULL_FIELDS)
FLOATS = {n for n, t, _ in FULL_FIELDS if isinstance(t, FloatType)}
S = "CAST(NULL AS VARCHAR)"

KEY = "CAST(user_id AS VARCHAR)"
NULL_KEY = f"CASE WHEN value >= {NULL_KEY_BELOW} THEN CAST(user_id AS VARCHAR) END"
ARRIVAL = f"epoch_us(ts) + CAST(floor(value * {DELAY_MICROS}) AS BIGINT)"
HOT = f"CASE WHEN value < {HOT_KEY_BELOW} THEN '{HOT_KEY}' ELSE CAST(user_id AS VARCHAR) END"


def _d(c: str, alias: str | None = None) -> str:
    """Column widened to double if it is a float field."""
    a = alias or c
    return f"CAST({c} AS DOUBLE) AS {a}" if a in FLOATS else (f"{c} AS {a}" if alias else c)


def _personal(key=KEY, age_null=False) -> str:
    age = "CAST(value AS FLOAT)"
    if age_null:
        age = f"CASE WHEN NOT (value >= {NULL_AGE_FROM}) THEN CAST(value AS FLOAT) END"
    return (f"SELECT {key} AS key, ts, event_id AS id, epoch_us(ts) AS t, {ARRIVAL} AS seq, "
            f"CAST(user_id AS INTEGER) AS empId, event_type AS firstName, props AS lastName, "
            f"{age} AS age, {S} AS sex FROM events WHERE event_type = 'view'")


def _address(key=KEY, shift=0) -> str:
    return (f"SELECT {key} AS key, ts, event_id AS id, epoch_us(ts) AS t, {ARRIVAL} AS seq, "
            f"CAST(user_id + {shift} AS INTEGER) AS empId, event_type AS houseName, "
            f"props AS streetName, {S} AS city, CAST(value AS FLOAT) AS postcode, "
            f"{S} AS district, {S} AS state, {S} AS country "
            f"FROM events WHERE event_type = 'purchase'")


def _vehicle() -> str:
    return (f"SELECT {KEY} AS key, ts, event_id AS id, CAST(user_id AS INTEGER) AS empId, "
            f"CAST(value AS FLOAT) AS vehicleNumber, props AS vehicleName, "
            f"event_type AS insuranceDetails, CAST(2024 AS FLOAT) AS manufacturingYear "
            f"FROM events WHERE event_type = 'click'")


def _late_ctes() -> str:
    """CTEs w (both sides in arrival order with the watermark before each) and late."""
    side = "SELECT key, ts, id, t, seq, {} AS side FROM ({}) WHERE key IS NOT NULL"
    return f"""
w AS (
  SELECT *, max(t) OVER (ORDER BY seq, side, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - {GRACE_MS * 1000} AS mark
  FROM ({side.format(0, _personal())} UNION ALL {side.format(1, _address())})),
late AS (SELECT * FROM w WHERE t < mark)"""


def _join_ctes(emit="eager", window_ms=WINDOW_MS, key=KEY, shift=0, at="t", on_time=False) -> str:
    """CTEs p, a (the two sides, keys not null) and j (the outer join rows); rows arrive in
    the order of column ``at``; ``on_time`` leaves out the late ones."""
    fresh = " AND id NOT IN (SELECT id FROM late WHERE side = {})" if on_time else ""
    w = window_ms * 1000
    lf = f"(p.{at}, 0, p.id) < (a.{at}, 1, a.id)"
    lcols = ", ".join(f"p.{c} AS l_{c}" for c in P_FIELDS)
    rcols = ", ".join(f"a.{c} AS r_{c}" for c in A_FIELDS)
    lnull = ", ".join(f"NULL AS l_{c}" for c in P_FIELDS)
    rnull = ", ".join(f"NULL AS r_{c}" for c in A_FIELDS)
    early_r = f" AND (a.{at}, 1, a.id) < (p.{at}, 0, p.id)" if emit == "eager" else ""
    early_l = f" AND (p.{at}, 0, p.id) < (a.{at}, 1, a.id)" if emit == "eager" else ""
    return f"""
p AS (SELECT * FROM ({_personal(key)}) WHERE key IS NOT NULL{fresh.format(0)}),
a AS (SELECT * FROM ({_address(key, shift)}) WHERE key IS NOT NULL{fresh.format(1)}),
m AS (
  SELECT p.key, greatest(p.ts, a.ts) AS ts, p.id AS l_id, a.id AS r_id, p.ts AS l_ts,
         a.ts AS r_ts, {lcols}, {rcols},
         CASE WHEN {lf} THEN a.{at} ELSE p.{at} END AS emit_t,
         CASE WHEN {lf} THEN 1 ELSE 0 END AS emit_side,
         CASE WHEN {lf} THEN a.id ELSE p.id END AS emit_id,
         CASE WHEN {lf} THEN p.t ELSE a.t END AS peer_t,
         CASE WHEN {lf} THEN p.{at} ELSE a.{at} END AS peer_o,
         CASE WHEN {lf} THEN p.id ELSE a.id END AS peer_id
  FROM p JOIN a ON p.key = a.key AND abs(p.t - a.t) <= {w}),
lu AS (
  SELECT p.key, p.ts, p.id AS l_id, CAST(NULL AS BIGINT) AS r_id, p.ts AS l_ts,
         CAST(NULL AS TIMESTAMP) AS r_ts, {lcols}, {rnull},
         p.{at} AS emit_t, 0 AS emit_side, p.id AS emit_id,
         CAST(NULL AS BIGINT) AS peer_t, CAST(NULL AS BIGINT) AS peer_o,
         CAST(NULL AS BIGINT) AS peer_id
  FROM p WHERE NOT EXISTS (
    SELECT 1 FROM a WHERE a.key = p.key AND abs(a.t - p.t) <= {w}{early_r})),
ru AS (
  SELECT a.key, a.ts, CAST(NULL AS BIGINT) AS l_id, a.id AS r_id,
         CAST(NULL AS TIMESTAMP) AS l_ts, a.ts AS r_ts, {lnull}, {rcols},
         a.{at} AS emit_t, 1 AS emit_side, a.id AS emit_id,
         CAST(NULL AS BIGINT) AS peer_t, CAST(NULL AS BIGINT) AS peer_o,
         CAST(NULL AS BIGINT) AS peer_id
  FROM a WHERE NOT EXISTS (
    SELECT 1 FROM p WHERE p.key = a.key AND abs(p.t - a.t) <= {w}{early_l})),
j AS (SELECT * FROM m UNION ALL SELECT * FROM lu UNION ALL SELECT * FROM ru)"""


def _flat_cte() -> str:
    """CTE f: the flattened full-details record of every join row."""
    cols = []
    for c in FULL:
        if c == "empId":
            v = "CASE WHEN r_id IS NOT NULL THEN r_empId WHEN l_id IS NOT NULL THEN l_empId ELSE 0 END"
        elif c in P_FIELDS:
            v = f"CASE WHEN l_id IS NOT NULL THEN l_{c} END"
        elif c in A_FIELDS:
            v = f"CASE WHEN r_id IS NOT NULL THEN r_{c} END"
        else:
            v = "CAST(0 AS FLOAT)" if c in FLOATS else S
        if c in FLOATS:
            v = f"COALESCE({v}, CAST(0 AS FLOAT))"
        cols.append(f"{v} AS {c}")
    return (",\nf AS (SELECT key, ts, l_id, r_id, emit_t, emit_side, emit_id, peer_t, peer_o, peer_id, "
            + ", ".join(cols) + " FROM j)")


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts)


def _full_select(prefix: list[str], suffix: list[str]) -> str:
    return ", ".join([*prefix, *[_d(c) for c in FULL], *suffix])


def _table_sql(emit="eager", shift=0, at="t", where="", source="f") -> str:
    cols = ", ".join(_d(c) for c in FULL)
    return _with(_join_ctes(emit=emit, shift=shift, at=at), _flat_cte()) + f"""
SELECT {cols}, l_id, r_id FROM (
  SELECT *, row_number() OVER (
    PARTITION BY empId
    ORDER BY emit_t DESC, emit_side DESC, emit_id DESC, peer_t DESC NULLS LAST,
             peer_o DESC NULLS LAST, peer_id DESC NULLS LAST) AS rn
  FROM {source}) WHERE rn = 1{where}"""


def _scan_sql(src: str, fields: list[str]) -> str:
    return f"SELECT key, ts, id, {', '.join(_d(c) for c in fields)} FROM ({src})"


def oracle_sql() -> dict[str, str]:
    conform_src = _personal(age_null=True)
    q: dict[str, str] = {
        "scan_personal": _scan_sql(_personal(), P_FIELDS),
        "scan_address": _scan_sql(_address(), A_FIELDS),
        "scan_vehicle": _scan_sql(_vehicle(), V_FIELDS),
        "conform_personal": _scan_sql(conform_src, P_FIELDS) + " WHERE age IS NOT NULL",
        "conform_rejects": f"SELECT key, ts, id, {', '.join(_d(c) for c in P_FIELDS)}, "
                           f"'age' AS reason FROM ({conform_src}) WHERE age IS NULL",
        "conform_overflow":
            f"SELECT key, ts, id, {', '.join(_d(c) for c in P_FIELDS)}, "
            f"'overflow:empId' AS reason FROM ("
            f"SELECT * REPLACE (CAST(NULL AS INTEGER) AS empId) FROM ({_personal()}) x "
            f"JOIN (SELECT event_id, value, user_id FROM events) e ON e.event_id = x.id "
            f"WHERE value >= {NULL_AGE_FROM} AND user_id + {WIDE_EMPID} > 2147483647)",
        "tap_metrics": f"SELECT count(*) AS rows, max(empId) AS max_key FROM ({_personal()})",
        "tap_personal": _scan_sql(_personal(), P_FIELDS),
        "join_matched": _with(_join_ctes()) + "\nSELECT key, ts, l_id, r_id, l_ts, r_ts FROM m",
        "join_eager_left_unmatched": _with(_join_ctes()) + "\nSELECT key, ts, l_id FROM lu",
        "join_eager_right_unmatched": _with(_join_ctes()) + "\nSELECT key, ts, r_id FROM ru",
        "join_eager": _with(_join_ctes()) + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "join_eager_arrival": _with(_join_ctes(at="seq"))
        + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "emp_table_arrival": _table_sql(at="seq"),
        "emp_lookup_point": _table_sql(
            where=f" AND empId IN ({', '.join(map(str, LOOKUP_POINTS))})"),
        "emp_lookup_range": _table_sql(
            where=f" AND empId BETWEEN {LOOKUP_RANGE[0]} AND {LOOKUP_RANGE[1]}"),
        "join_eager_1s": _with(_join_ctes(window_ms=REFERENCE_WINDOW_MS))
        + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "join_eager_grace": _with(_late_ctes(), ",", _join_ctes(at="seq", on_time=True))
        + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "late_rows": _with(_late_ctes()) + "\nSELECT key, ts, id, side, mark AS watermark_us FROM late",
        "join_state_rows": f"""
WITH x AS (SELECT 0 AS side, t FROM ({_personal()}) UNION ALL SELECT 1, t FROM ({_address()})),
c AS (SELECT side, u, sum(n) AS n FROM (
        SELECT side, t AS u, 1 AS n FROM x
        UNION ALL SELECT side, t + {(WINDOW_MS + GRACE_MS) * 1000 + 1}, -1 FROM x) GROUP BY ALL),
r AS (SELECT side, u // 3600000000 AS h, n,
             sum(n) OVER (PARTITION BY side ORDER BY u) AS held FROM c)
SELECT side, (h * 3600)::BIGINT AS hour_s,
       max(greatest(held, held - n))::BIGINT AS peak_rows
FROM r GROUP BY side, h""",
        "join_settled": _with(_join_ctes(emit="settled")) + "\nSELECT key, ts, l_id, r_id FROM j",
        "join_null_keys": _with(_join_ctes(key=NULL_KEY))
        + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "join_hot_key": _with(_join_ctes(key=HOT))
        + "\nSELECT key, ts, l_id, r_id, emit_id FROM j",
        "flatten_join": _with(_join_ctes(), _flat_cte())
        + f"\nSELECT {_full_select(['key', 'ts'], ['l_id', 'r_id'])} FROM f",
        "flatten_empid_precedence": _with(_join_ctes(shift=EMPID_SHIFT), _flat_cte())
        + "\nSELECT key, l_id, r_id, empId, firstName, houseName FROM f",
        "flatten_defaults": _with(_join_ctes(), _flat_cte())
        + f"\nSELECT {_full_select(['key'], ['l_id', 'r_id'])} FROM f"
        " WHERE l_id IS NULL OR r_id IS NULL",
        "rekey_emp": _with(_join_ctes(shift=EMPID_SHIFT), _flat_cte())
        + "\nSELECT empId, key AS source_key, ts, l_id, r_id FROM f",
        "emp_changelog": _with(_join_ctes(), _flat_cte())
        + f"\nSELECT {_full_select([], ['l_id', 'r_id', 'emit_id'])} FROM f",
        "emp_changelog_cached": _with(_join_ctes(), _flat_cte())
        + f"""\nSELECT {_full_select([], ['l_id', 'r_id', 'emit_id'])} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY empId, emit_t // {COMMIT_MS * 1000}
    ORDER BY emit_t DESC, emit_side DESC, emit_id DESC, peer_t DESC NULLS LAST,
             peer_o DESC NULLS LAST, peer_id DESC NULLS LAST) AS rn
  FROM f) WHERE rn = 1""",
        "emp_lookup_point_shifted": _table_sql(
            shift=EMPID_SHIFT, where=f" AND empId IN ({', '.join(str(p + d) for p in LOOKUP_POINTS[:3] for d in (0, EMPID_SHIFT))})"),
        "emp_lookup_asof": _with(_join_ctes(), _flat_cte()) + f""",
v AS (SELECT id, empId, epoch_us(ts) AS u FROM ({_vehicle()}))
SELECT id AS vehicle_id, empId, firstName, lastName, {_d('age')}, houseName, streetName,
       {_d('postcode')}, l_id, r_id
FROM (
  SELECT v.id, v.empId, f.* EXCLUDE (empId), row_number() OVER (
    PARTITION BY v.id
    ORDER BY emit_t DESC NULLS LAST, emit_side DESC, emit_id DESC, peer_t DESC NULLS LAST,
             peer_o DESC NULLS LAST, peer_id DESC NULLS LAST) AS rn
  FROM v LEFT JOIN f ON f.empId = v.empId AND f.emit_t <= v.u) WHERE rn = 1""",
        "emp_table": _table_sql(),
        "stream_emp_table": _table_sql(),
        # Spark keeps the watermark in whole milliseconds
        "stream_late_rows": f"""
WITH b AS (SELECT min({ARRIVAL}) AS lo, max({ARRIVAL}) AS hi FROM events),
w AS (SELECT 0 AS side, key, id, t, seq FROM ({_personal()})
      UNION ALL SELECT 1, key, id, t, seq FROM ({_address()})),
s AS (SELECT *, (seq - lo) // ((hi - lo) // {LATE_SLICES} + 1) AS slice FROM w, b WHERE key IS NOT NULL),
m AS (SELECT slice, max(max(t)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING
                                      AND 1 PRECEDING) AS seen FROM s GROUP BY slice)
SELECT side, key, id FROM s JOIN m USING (slice) WHERE t < (seen // 1000) * 1000 - {GRACE_MS * 1000}""",
        # the slices of the replay are as wide as whole microseconds allow
        "emp_table_as_of_batch": _table_sql(source=f"""(
    SELECT f.* FROM f, (SELECT min(emit_t) AS lo, max(emit_t) AS hi FROM f) b
    WHERE emit_t < lo + {AS_OF_SLICE} * ((hi - lo) // {REPLAY_SLICES} + 1))"""),
        "frame_rejects": f"""
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS id, decode_error FROM (
  SELECT *, CASE WHEN value < {NULL_KEY_BELOW} OR coalesce(strlen(props), 0) = 0 THEN 'frame:short'
                 WHEN value >= {HOT_KEY_BELOW} AND value < {2 * HOT_KEY_BELOW} THEN 'frame:magic'
                 WHEN value >= {NULL_AGE_FROM} THEN 'frame:schema {OTHER_SCHEMA_ID}' END AS decode_error
  FROM events WHERE event_type = 'view') WHERE decode_error IS NOT NULL""",
        "stream_join_settled": _with(_join_ctes(emit="settled"))
        + "\nSELECT key, epoch_us(ts) AS ts_us, l_id, r_id, emit_id FROM j",
        "emp_table_settled": _table_sql(emit="settled"),
        "emp_table_shifted": _table_sql(shift=EMPID_SHIFT),
        "emp_lookup": f"""WITH t AS ({_table_sql()}),
v AS ({_vehicle()})
SELECT v.id AS vehicle_id, v.empId, t.firstName, t.lastName, t.age, t.houseName,
       t.streetName, t.postcode
FROM v LEFT JOIN t ON t.empId = v.empId""",
    }
    return q
