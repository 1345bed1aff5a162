"""Hand-made cases (FIXTURES.md): window edges, many-to-many, nulls, types."""

from __future__ import annotations

import pytest

from keyweave.plans.topology import employee_tables
from keyweave.sources.conform import conform

W = 1000


def P(emp, first="f", last="l", age=30.0, sex="m"):
    return {"empId": emp, "firstName": first, "lastName": last, "age": age, "sex": sex}


def A(emp, house="h", street="s", postcode=1234.0):
    return {"empId": emp, "houseName": house, "streetName": street, "city": "c",
            "postcode": postcode, "district": "d", "state": "st", "country": "co"}


def run(mk, personal, address, emit="eager", seq=False):
    p = mk("personal", personal, seq=seq)
    a = mk("address", address, seq=seq)
    t = employee_tables(p, a, window_ms=W, emit=emit, conformed=False,
                        arrival="seq" if seq else None)
    rows = t.joined.orderBy("emit_o1", "emit_side", "emit_id", "peer_t", "peer_o1",
                            "peer_id").collect()
    table = {r.empId: r for r in t.table.collect()}
    return [(r.l_id, r.r_id, r.empId) for r in rows], table


@pytest.mark.parametrize("emit", ["eager", "settled"])
def test_match_left_first(mk, emit):
    rows, table = run(mk, [("a", 10000, 1, P(1))], [("a", 10500, 2, A(1))], emit)
    assert rows == ([(1, None, 1), (1, 2, 1)] if emit == "eager" else [(1, 2, 1)])
    assert (table[1].l_id, table[1].r_id) == (1, 2)


@pytest.mark.parametrize("emit", ["eager", "settled"])
def test_match_right_first(mk, emit):
    rows, table = run(mk, [("a", 10500, 1, P(1))], [("a", 10000, 2, A(1))], emit)
    assert rows == ([(None, 2, 1), (1, 2, 1)] if emit == "eager" else [(1, 2, 1)])
    assert (table[1].l_id, table[1].r_id) == (1, 2)


def test_edge_inside(mk):
    rows, table = run(mk, [("a", 10000, 1, P(1))], [("a", 11000, 2, A(1))])
    assert rows == [(1, None, 1), (1, 2, 1)]


@pytest.mark.parametrize("emit", ["eager", "settled"])
def test_edge_outside_wipes_personal(mk, emit):
    rows, table = run(mk, [("a", 10000, 1, P(1))], [("a", 11001, 2, A(1))], emit)
    assert rows == [(1, None, 1), (None, 2, 1)]
    r = table[1]
    assert (r.l_id, r.r_id) == (None, 2)
    assert r.firstName is None and r.age == 0.0 and r.houseName == "h"


def test_many_to_many(mk):
    rows, table = run(
        mk,
        [("a", 10000, 1, P(1)), ("a", 10100, 2, P(1))],
        [("a", 10200, 3, A(1)), ("a", 10300, 4, A(1))],
    )
    assert rows == [(1, None, 1), (2, None, 1), (1, 3, 1), (2, 3, 1), (1, 4, 1), (2, 4, 1)]
    assert (table[1].l_id, table[1].r_id) == (2, 4)


def test_many_to_many_settled(mk):
    rows, _ = run(
        mk,
        [("a", 10000, 1, P(1)), ("a", 10100, 2, P(1))],
        [("a", 10200, 3, A(1)), ("a", 10300, 4, A(1))],
        "settled",
    )
    assert sorted(rows) == [(1, 3, 1), (1, 4, 1), (2, 3, 1), (2, 4, 1)]


def test_key_differs_from_empid(mk):
    rows, table = run(mk, [("k", 10000, 1, P(1))], [("k", 10500, 2, A(2))])
    assert rows == [(1, None, 1), (1, 2, 2)]
    assert set(table) == {1, 2}
    assert (table[1].l_id, table[1].r_id) == (1, None)
    assert (table[2].l_id, table[2].r_id) == (1, 2)
    rows, table = run(mk, [("k", 10000, 1, P(1))], [("k", 10500, 2, A(2))], "settled")
    assert rows == [(1, 2, 2)] and set(table) == {2}


@pytest.mark.parametrize("emit", ["eager", "settled"])
def test_null_key_dropped(mk, emit):
    rows, table = run(mk, [(None, 10000, 1, P(1))], [(None, 10000, 2, A(1))], emit)
    assert rows == [] and table == {}


def test_tombstone_dropped(mk):
    rows, table = run(mk, [("a", 10000, 1, None)], [("a", 10000, 2, None)])
    assert rows == [] and table == {}


@pytest.mark.parametrize("emit", ["eager", "settled"])
def test_late_arrival_in_window(mk, emit):
    # address arrives first although its event time is later
    rows, table = run(mk, [("a", 10000, 1, P(1), 2)], [("a", 10800, 2, A(1), 1)], emit, seq=True)
    assert rows == ([(None, 2, 1), (1, 2, 1)] if emit == "eager" else [(1, 2, 1)])
    assert (table[1].l_id, table[1].r_id) == (1, 2)


def test_float32_rounding(mk):
    rows, table = run(mk, [("a", 10000, 1, P(1))], [("a", 10500, 2, A(1, postcode=16777217.0))])
    assert table[1].postcode == 16777216.0


def test_required_field_null_rejected(mk):
    raw = mk("personal", [("a", 10000, 1, P(1, age=None)), ("a", 10001, 2, P(1))])
    c = conform(raw, "personal")
    assert [r.id for r in c.ok.collect()] == [2]
    rej = c.rejected.collect()
    assert [(r.id, r.reason) for r in rej] == [(1, "age")]


def test_absent_side_defaults(mk):
    rows, table = run(mk, [("a", 10000, 1, P(7))], [])
    r = table[7]
    assert (r.age, r.postcode, r.vehicleNumber, r.manufacturingYear) == (30.0, 0.0, 0.0, 0.0)
    assert r.houseName is None and r.vehicleName is None and r.insuranceDetails is None


def test_address_empid_wins(mk):
    rows, table = run(mk, [("a", 10000, 1, P(5))], [("a", 10010, 2, A(6))])
    assert rows[-1] == (1, 2, 6)
