"""Batch join + table equal a record-at-a-time simulation on random cases.

Many independent cases go through one Spark job: each case has its own message
keys and empIds. Checked per case: the eager rows in emission order, the
settled rows as a set, and the final table.
"""

from __future__ import annotations

import random

import pytest

from keyweave.operators.interval_join import ORDER_COLUMNS
from keyweave.plans.topology import employee_tables
from tests.simulate import settled, simulate
from tests.test_fixtures import A, P

W = 1000


def make_cases(seed: int, n: int, *, shuffle: bool, key_is_emp: bool):
    rng = random.Random(seed)
    cases, nid = [], 1
    for c in range(n):
        recs = []
        for k in range(rng.randint(1, 3)):
            key = None if rng.random() < 0.05 else f"c{c}k{k}"
            for side in ("L", "R"):
                for _ in range(rng.randint(0, 5)):
                    emp = c * 100 + (k if key_is_emp else rng.randint(0, 3))
                    t = 10000 + rng.randint(0, 4 * W) // rng.choice([1, 50, 250]) * rng.choice([1, 50, 250])
                    val = P(emp, first=f"p{nid}") if side == "L" else A(emp, house=f"h{nid}")
                    if rng.random() < 0.05:
                        val = None
                    recs.append({"side": side, "key": key, "ts": t, "id": nid, "value": val})
                    nid += 1
        if shuffle:
            rng.shuffle(recs)
        else:
            recs.sort(key=lambda r: (r["ts"], 0 if r["side"] == "L" else 1, r["id"]))
        for i, r in enumerate(recs):
            r["seq"] = i
        cases.append(recs)
    return cases


def spark_run(mk, cases, emit, shuffle):
    rows = {"L": [], "R": []}
    for recs in cases:
        for r in recs:
            rows[r["side"]].append((r["key"], r["ts"], r["id"], r["value"], r["seq"]))
    p = mk("personal", rows["L"], seq=True)
    a = mk("address", rows["R"], seq=True)
    t = employee_tables(p, a, window_ms=W, emit=emit, conformed=False,
                        arrival="seq" if shuffle else None)
    joined = t.joined.select("key", "l_id", "r_id", *ORDER_COLUMNS).collect()
    table = t.table.select("empId", "l_id", "r_id", "firstName", "houseName", "age",
                           "postcode").collect()
    return joined, table


def case_of_id(cases):
    m = {}
    for c, recs in enumerate(cases):
        for r in recs:
            m[r["id"]] = c
    return m


@pytest.mark.parametrize("shuffle", [False, True], ids=["in_order", "shuffled"])
@pytest.mark.parametrize("key_is_emp", [True, False], ids=["key_eq_emp", "key_ne_emp"])
def test_eager_matches_simulation(mk, shuffle, key_is_emp):
    cases = make_cases(7 + 2 * shuffle + key_is_emp, 60, shuffle=shuffle, key_is_emp=key_is_emp)
    joined, table = spark_run(mk, cases, "eager", shuffle)
    owner = case_of_id(cases)
    by_case: dict[int, list] = {}
    for r in sorted(joined, key=lambda r: tuple(
            (x is not None, x) for x in (r[c] for c in ORDER_COLUMNS))):
        by_case.setdefault(owner[r.l_id if r.l_id is not None else r.r_id], []).append(
            (r.l_id, r.r_id))
    tab = {r.empId: r for r in table}
    n_rows = 0
    for c, recs in enumerate(cases):
        emitted, sim_table = simulate(recs, W)
        n_rows += len(emitted)
        assert by_case.get(c, []) == emitted, f"case {c}"
        for emp, (row, lid, rid) in sim_table.items():
            got = tab[emp]
            assert (got.l_id, got.r_id) == (lid, rid), f"case {c} emp {emp}"
            assert (got.firstName, got.houseName, got.age, got.postcode) == (
                row["firstName"], row["houseName"], row["age"], row["postcode"])
    assert len(tab) == sum(len(simulate(r, W)[1]) for r in cases)
    assert n_rows > 100


@pytest.mark.parametrize("shuffle", [False, True], ids=["in_order", "shuffled"])
def test_settled_matches_simulation(mk, shuffle):
    cases = make_cases(101 + shuffle, 60, shuffle=shuffle, key_is_emp=False)
    joined, _ = spark_run(mk, cases, "settled", shuffle)
    got = {(r.l_id, r.r_id) for r in joined}
    assert len(got) == len(joined)
    want = set().union(*[settled(recs, W) for recs in cases])
    assert got == want
