"""Reconciliation, the daily rolling mart, scorecard ranks and percentiles."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cargoline import operators as ops
from helpers import orders, shipments


def _long(spark, values: dict):
    return spark.createDataFrame(list(values.items()), "metric string, value double")


def test_reconciliation_detects_a_difference(spark):
    py = {m: 1.0 for m in ops.RECONCILED_METRICS}
    sq = dict(py, otif_rate=0.5)
    status = {r.metric: r.status for r in ops.reconcile_metrics(_long(spark, py), _long(spark, sq)).collect()}
    assert status.pop("otif_rate") == "FAIL"
    assert set(status.values()) == {"PASS"} and len(status) == 7


def test_reconciliation_missing_and_nan_metrics_fail(spark):
    py = {m: 1.0 for m in ops.RECONCILED_METRICS}
    sq = {m: 1.0 for m in ops.RECONCILED_METRICS if m != "backorder_rate"}
    sq["unit_fill_rate"] = float("nan")
    status = {r.metric: r.status for r in ops.reconcile_metrics(_long(spark, py), _long(spark, sq)).collect()}
    assert status["backorder_rate"] == "FAIL" and status["unit_fill_rate"] == "FAIL"
    assert status["otif_rate"] == "PASS"


def test_reconciliation_rounding_and_tolerance(spark):
    py = {m: 1.0 for m in ops.RECONCILED_METRICS}
    sq = dict(py, total_cost_to_serve=1.004, otif_rate=1.0 + 5e-10)
    rows = {r.metric: r for r in ops.reconcile_metrics(_long(spark, py), _long(spark, sq)).collect()}
    assert rows["total_cost_to_serve"].sql_value == 1.0 and rows["total_cost_to_serve"].status == "PASS"
    assert rows["otif_rate"].status == "PASS"


def test_reconciliation_report_is_stable(spark):
    py = _long(spark, {m: i / 7 for i, m in enumerate(ops.RECONCILED_METRICS)})
    sq = _long(spark, {m: i / 7 + (1e-6 if i == 3 else 0) for i, m in enumerate(ops.RECONCILED_METRICS)})
    first = sorted(ops.reconcile_metrics(py, sq).collect())
    second = sorted(ops.reconcile_metrics(py, sq).collect())
    assert first == second


def test_rolling_rates_use_natural_weights(spark):
    o = orders(spark, [
        ("O1", "C1", "W1", "2025-01-01", "2025-01-01", 100, 100, 100),
        ("O2", "C1", "W1", "2025-01-02", "2025-01-02", 1, 0, 0),
        ("O3", "C1", "W1", "2025-01-02", "2025-01-02", 1, 0, 0),
        ("O4", "C1", "W1", "2025-01-02", "2025-01-02", 1, 0, 0),
    ])
    s = shipments(spark, [(f"O{i}", "A", "2025-01-02", 1, 0, 0, 1) for i in range(1, 5)])
    daily = ops.mart_daily_service(ops.mart_order_service(o, s))
    row = daily.filter(F.col("order_date") == dt.date(2025, 1, 2)).collect()[0]
    assert row.rolling_30d_orders == 4
    assert row.rolling_30d_otd_rate == 3 / 4
    assert row.rolling_30d_fill_rate == 100 / 103
    assert row.day_over_day_otd_change == 1.0


def test_rolling_window_is_calendar_days_and_lag_is_previous_observed_day(spark):
    days = ["2025-01-01", "2025-01-20", "2025-01-30", "2025-01-31", "2025-03-15"]
    o = orders(spark, [(f"O{i}", "C1", "W1", day, day, 1, 1, 1) for i, day in enumerate(days)])
    s = shipments(spark, [(f"O{i}", "A", day if i % 2 == 0 else "2025-12-31", 1, 0, 0, 1) for i, day in enumerate(days)])
    rows = {str(r.order_date): r for r in ops.mart_daily_service(ops.mart_order_service(o, s)).collect()}
    assert rows["2025-01-30"].rolling_30d_orders == 3  # Jan 1 .. Jan 30 is 30 days
    assert rows["2025-01-31"].rolling_30d_orders == 3  # Jan 1 drops out
    assert rows["2025-03-15"].rolling_30d_orders == 1  # gap of more than 29 days
    assert rows["2025-03-15"].day_over_day_otd_change == 1.0  # vs Jan 31 (late), not Mar 14
    assert rows["2025-01-01"].day_over_day_otd_change is None


def test_rolling_sum_equals_direct_sum_property(spark):
    rnd = random.Random(7)
    base = dt.date(2025, 1, 1)
    rows = []
    for i in range(300):
        day = base + dt.timedelta(days=rnd.randrange(0, 200))
        rows.append((f"O{i}", "C", rnd.choice(["W1", "W2"]), str(day), str(day), rnd.randrange(1, 9), rnd.randrange(0, 9), 1))
    o = orders(spark, [(a, b, c, d_, e, u, min(s_, u), r) for a, b, c, d_, e, u, s_, r in rows])
    s = shipments(spark, [(r[0], "A", r[3], 1, 0, 0, 1) for r in rows[::2]])
    mart = ops.mart_order_service(o, s)
    for keys in ([], ["warehouse"]):
        out = ops.mart_daily_service(mart, keys).collect()
        plain = mart.collect()
        for r in out:
            lo = r.order_date - dt.timedelta(days=29)
            want = [p for p in plain if lo <= p.order_date <= r.order_date
                    and all(getattr(p, k) == getattr(r, k) for k in keys)]
            assert r.rolling_30d_orders == len(want)
            assert r.rolling_30d_units_ordered == sum(p.units_ordered for p in want)


def test_carrier_ranks_keep_null_carrier_last(spark):
    o = orders(spark, [
        ("O1", "C1", "W1", "2025-01-01", "2025-01-05", 10, 10, 100),
        ("O2", "C1", "W1", "2025-01-01", "2025-01-05", 10, 8, 100),
        ("O3", "C1", "W1", "2025-01-01", "2025-01-05", 10, 10, 100),
        ("O4", "C1", "W1", "2025-01-01", "2025-01-05", 10, 10, 100),
    ])
    s = shipments(spark, [("O1", "A", "2025-01-05", 10, 1, 0, 5), ("O2", "B", "2025-01-05", 30, 1, 0, 5),
                          ("O3", "B", "2025-01-05", 10, 1, 0, 5)])
    sc = {r.carrier: r for r in ops.mart_carrier_scorecard(ops.mart_order_service(o, s)).collect()}
    assert sc["A"].service_rank == 1 and sc["B"].service_rank == 2 and sc[None].service_rank == 3
    assert sc["A"].cost_rank == 1 and sc["B"].cost_rank == 2 and sc[None].cost_rank == 3
    assert sc[None].orders == 1 and sc[None].p90_freight_cost_per_kg is None
    assert abs(sc["B"].p90_freight_cost_per_kg - (2.0 + 0.9 * 4.0)) < 1e-9
    frame = {r.carrier for r in ops.carrier_scorecard(ops.order_service(o, s)).collect()}
    assert frame == {"A", "B"}


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 0.999, 1.0])
def test_exact_percentile_matches_builtin(spark, p):
    rnd = random.Random(11)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), float(rnd.choice(range(50))) + rnd.random())
            for _ in range(5000)]
    rows += [("ties", 1.0)] * 2000 + [("ties", 2.0)] * 10 + [("single", 3.5), ("empty", None)]
    for n in list(range(2, 70)) + [99, 150, 333, 1001]:  # small groups: one rank is a large share
        rows += [(f"g{n}", rnd.random() * 100) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    exact = {r.k: r.q for r in ops.percentile_cont(df, ["k"], "v", p, "q", accuracy=100).collect()}
    builtin = {r.k: r.q for r in ops.percentile_cont(df, ["k"], "v", p, "q", method="builtin").collect()}
    assert set(exact) == set(builtin) and exact["empty"] is None and builtin["empty"] is None
    for k in builtin:
        if builtin[k] is not None:
            assert abs(exact[k] - builtin[k]) <= 1e-9 * max(1.0, abs(builtin[k])), k
    whole = ops.percentile_cont(df, [], "v", p, "q", accuracy=100).collect()[0].q
    ref = df.agg(F.percentile("v", p)).collect()[0][0]
    assert abs(whole - ref) <= 1e-9 * max(1.0, abs(ref))


def test_service_segments_sum_to_one_and_otif_bounded(spark):
    o, s = _otif_like(spark)
    svc = ops.order_service(o, s)
    seg = ops.service_segments(svc).collect()
    assert abs(sum(r.share for r in seg) - 1.0) < 1e-12 and sum(r.orders for r in seg) == 6
    m = {r.metric: r.value for r in ops.kpi_summary(
        svc,
        spark.createDataFrame([(1, 1)], "forecast_units long, actual_units long"),
        spark.createDataFrame([(1, 1.0)], "on_hand_units long, average_daily_demand double"),
        spark.createDataFrame([(1, 1.0)], "units_processed long, labor_hours double"),
    ).collect()}
    assert m["otif_rate"] <= min(m["complete_order_rate"], m["on_time_delivery_rate"])


def _otif_like(spark):
    rows, ships = [], []
    for i in range(6):
        rows.append((f"O{i}", "C", "W", "2025-01-01", "2025-01-05", 10, 10 - (i % 2), 10))
        if i != 5:
            ships.append((f"O{i}", "A", "2025-01-05" if i < 3 else "2025-01-07", 1, 1, 0, 1))
    return orders(spark, rows), shipments(spark, ships)


def test_null_order_date_is_its_own_day(spark):
    from pyspark.sql import types as T

    from helpers import ORDER_SCHEMA

    rows = [("O1", "C", "W", dt.date(2025, 1, 1), dt.date(2025, 1, 2), 1, 1, None),
            ("O2", "C", "W", None, dt.date(2025, 1, 2), 1, 0, None),
            ("O3", "C", "W", None, None, 2, 2, None)]
    o = spark.createDataFrame(rows, ORDER_SCHEMA)
    s = shipments(spark, [("O1", "A", "2025-01-02", 1, 0, 0, 1), ("O2", "A", "2025-01-02", 1, 0, 0, 1)])
    mart = ops.mart_order_service(o, s)
    daily = {r.order_date: r for r in ops.mart_daily_service(mart).collect()}
    assert daily[None].orders == 2 and daily[None].rolling_30d_orders == 2
    assert daily[dt.date(2025, 1, 1)].rolling_30d_orders == 1
    frame = {r.order_id: r for r in ops.order_service(o, s).collect()}
    assert frame["O2"].order_date is None and frame["O2"].lead_time_days is None
    assert frame["O3"].on_time is False  # no promise and no delivery: late under the dataframe policy
    del T


def test_supplier_score_with_no_backorders_uses_floor(spark):
    lines = spark.createDataFrame([("O1", "S1"), ("O2", "S2")], "order_id string, supplier_id string")
    service = spark.createDataFrame([("O1", True, 0), ("O2", False, 0)], "order_id string, otif boolean, backorder_units long")
    sup = spark.createDataFrame([("S1", "a", 5, "Medium"), ("S2", "b", 5, "Low")],
                                "supplier_id string, supplier_name string, base_lead_time_days int, supplier_risk_tier string")
    sc = {r.supplier_id: r.resilience_risk_score for r in ops.supplier_risk_scorecard(lines, sup, service).collect()}
    assert abs(sc["S1"] - 0.15 * 0.15) < 1e-12 and abs(sc["S2"] - 0.6) < 1e-12


def test_hot_keys_match_brute_force(spark):
    """One order, one carrier and one day hold a third of the rows; every
    aggregate still equals a plain Python computation."""
    rnd = random.Random(3)
    line_rows, ship_rows = [], []
    for i in range(900):
        oid = "HOT" if i % 3 == 0 else f"O{i}"
        day = "2025-02-01" if i % 3 == 0 else f"2025-01-{1 + i % 28:02d}"
        u = rnd.randrange(1, 20)
        line_rows.append((oid, "C1" if i % 3 == 0 else f"C{i % 17}", "W1", day, day, u, u - (i % 5 == 0), 1))
    for oid in {r[0] for r in line_rows}:
        ship_rows.append((oid, "A" if oid == "HOT" or hash(oid) % 3 == 0 else "B", "2025-02-01", 10, 1, 0, 5))
    o = orders(spark, line_rows)
    s = shipments(spark, ship_rows)
    svc = {r.order_id: r for r in ops.order_service(o, s).collect()}
    hot = [r for r in line_rows if r[0] == "HOT"]
    assert svc["HOT"].units_ordered == sum(r[5] for r in hot)
    assert svc["HOT"].units_shipped == sum(r[6] for r in hot)
    assert len(svc) == len({r[0] for r in line_rows})
    sup_lines = spark.createDataFrame([(r[0], "S-HOT" if r[0] == "HOT" else f"S{i % 4}") for i, r in enumerate(line_rows)],
                                      "order_id string, supplier_id string")
    sups = spark.createDataFrame([(x, x, 5, "Low") for x in ("S-HOT", "S0", "S1", "S2", "S3")],
                                 "supplier_id string, supplier_name string, base_lead_time_days int, supplier_risk_tier string")
    risk = {r.supplier_id: r for r in ops.supplier_risk_scorecard(sup_lines, sups, ops.order_service(o, s)).collect()}
    assert risk["S-HOT"].orders == 1 and risk["S-HOT"].backorder_units == svc["HOT"].backorder_units
    daily = {str(r.order_date): r for r in ops.mart_daily_service(ops.mart_order_service(o, s)).collect()}
    assert daily["2025-02-01"].orders == 1  # the hot order is one order, however many lines
    carriers = {r.carrier: r.orders for r in ops.carrier_scorecard(ops.order_service(o, s)).collect()}
    assert sum(carriers.values()) == len(svc)
