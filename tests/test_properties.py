"""Property tests (hypothesis): random orders and shipments, plain-Python truth."""
from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cargoline import operators as ops
from helpers import orders, shipments

order_st = st.lists(
    st.tuples(
        st.integers(1, 6),            # order number (several lines per order)
        st.integers(0, 20),           # ordered
        st.integers(0, 20),           # shipped (may exceed ordered: over-shipping)
        st.integers(-1, 4),           # delivery offset to promise; -1 with no shipment below
        st.booleans(),                # has a shipment
        st.integers(0, 3),            # shipment weight (0 -> no cost per kg)
    ),
    min_size=1, max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order_st)
def test_service_invariants(spark, rows):
    line_rows, ships, truth = [], {}, {}
    for n, ordered, shipped, offset, has_ship, weight in rows:
        oid = f"O{n}"
        line_rows.append((oid, "C", "W", "2025-01-01", "2025-01-05", ordered, shipped, 1))
        t = truth.setdefault(oid, [0, 0])
        t[0] += ordered
        t[1] += shipped
        if has_ship and oid not in ships:
            ships[oid] = (oid, "A", f"2025-01-{5 + offset:02d}", 10, 1, 0, weight)
    o = orders(spark, line_rows)
    s = shipments(spark, list(ships.values()) or [("none", "A", "2025-01-05", 1, 0, 0, 1)])
    frame = {r.order_id: r for r in ops.order_service(o, s).collect()}
    mart = {r.order_id: r for r in ops.mart_order_service(o, s).collect()}
    assert set(frame) == set(truth) == set(mart)
    for oid, (ordered, shipped) in truth.items():
        f, m = frame[oid], mart[oid]
        assert (f.units_ordered, f.units_shipped) == (ordered, shipped)
        assert f.backorder_units == max(ordered - shipped, 0) == m.backorder_units
        assert f.in_full == (shipped >= ordered) == m.in_full
        assert f.otif == (f.in_full and f.on_time)
        if oid in ships:
            assert f.on_time == m.on_time and f.otif == m.otif
            assert (f.freight_cost_per_kg is None) == (ships[oid][6] == 0)
        else:
            assert f.on_time is False and m.on_time is None and float(f.cost_to_serve) == 0.0
            assert m.otif is (None if f.in_full else False)
    n = len(truth)
    wide = ops.mart_kpi_summary(ops.mart_order_service(o, s)).collect()[0]
    assert wide.total_orders == n
    total_o = sum(v[0] for v in truth.values())
    total_s = sum(v[1] for v in truth.values())
    assert wide.unit_fill_rate == (total_s / total_o if total_o else None)
    in_full = sum(1 for v in truth.values() if v[1] >= v[0])
    assert wide.complete_order_rate == in_full / n
    if wide.otif_rate is not None:  # OTIF never exceeds either component
        assert wide.otif_rate <= wide.complete_order_rate + 1e-12 or wide.on_time_delivery_rate is None
