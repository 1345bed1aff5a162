"""Record-at-a-time model of the reference topology, for tests only.

Records are processed one by one in arrival order. Each side keeps a window
buffer per key; an arriving record joins every buffered record of the other
side within the window (in buffer order: timestamp, then arrival), or is emitted
alone when there is none. Each joined row is flattened, re-keyed by empId and
overwrites the table entry.
"""

from __future__ import annotations

from collections import defaultdict

P = ["empId", "firstName", "lastName", "age", "sex"]
A = ["empId", "houseName", "streetName", "city", "postcode", "district", "state", "country"]
FULL = ["empId", "firstName", "lastName", "age", "sex", "houseName", "streetName", "city",
        "postcode", "district", "state", "country", "vehicleNumber", "vehicleName",
        "insuranceDetails", "manufacturingYear"]
FLOATS = {"age", "postcode", "vehicleNumber", "manufacturingYear"}


def flatten(left: dict | None, right: dict | None) -> dict:
    rec = {f: (0.0 if f in FLOATS else None) for f in FULL}
    rec["empId"] = 0
    if left is not None:
        for f in P:
            rec[f] = left[f]
    if right is not None:
        for f in A:
            rec[f] = right[f]
    return rec


def simulate(records, window_ms: int):
    """records: dicts with side ('L'/'R'), key, ts (ms), id, value (dict or None),
    in arrival order. Returns (emitted rows as (l_id, r_id), table by empId)."""
    buf = {"L": defaultdict(list), "R": defaultdict(list)}
    emitted, table = [], {}
    for pos, rec in enumerate(records):
        if rec["key"] is None or rec["value"] is None:
            continue
        side, other = rec["side"], "R" if rec["side"] == "L" else "L"
        cands = [o for o in buf[other][rec["key"]] if abs(o["ts"] - rec["ts"]) <= window_ms]
        cands.sort(key=lambda o: (o["ts"], o["_pos"]))
        pairs = [(o, rec) if side == "R" else (rec, o) for o in cands] or (
            [(rec, None)] if side == "L" else [(None, rec)])
        for lrec, rrec in pairs:
            row = flatten(lrec and lrec["value"], rrec and rrec["value"])
            emitted.append((lrec and lrec["id"], rrec and rrec["id"]))
            table[row["empId"]] = (row, lrec and lrec["id"], rrec and rrec["id"])
        buf[side][rec["key"]].append({**rec, "_pos": pos})
    return emitted, table


def settled(records, window_ms: int):
    """Pairs plus rows that have no partner at all (as a set of (l_id, r_id))."""
    recs = [r for r in records if r["key"] is not None and r["value"] is not None]
    ls = [r for r in recs if r["side"] == "L"]
    rs = [r for r in recs if r["side"] == "R"]
    out = set()
    for l in ls:
        m = [r for r in rs if r["key"] == l["key"] and abs(r["ts"] - l["ts"]) <= window_ms]
        out |= {(l["id"], r["id"]) for r in m}
        if not m:
            out.add((l["id"], None))
    for r in rs:
        if not any(l["key"] == r["key"] and abs(r["ts"] - l["ts"]) <= window_ms for l in ls):
            out.add((None, r["id"]))
    return out
