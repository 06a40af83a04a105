"""All 38 report checks pass on clean sources and each one fails on its own defect;
duplicate keys, missing dates and further warehouses."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline import operators as ops
from cargoline.plans.model import FulfillmentModel
from cargoline.schemas import source_schemas
from cargoline.operators.demand import demand_cells, monthly_demand_grid
from cargoline.sources.readers import Sources

D = dt.date


def m(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


CLEAN = {
    "customers": [("C1", "Retail", "EU"), ("C2", "Pro", "US")],
    "suppliers": [("S1", "One", 5, "Low"), ("S2", "Two", 7, "High")],
    "products": [("P1", "A", "S1", m(10), m(1)), ("P2", "B", "S2", m(20), m(2))],
    "erp_order_lines": [
        ("O1-1", "O1", "C1", "W1", D(2024, 1, 5), D(2024, 1, 9), "P1", "S1", 10, 10, m(10), m(1), m(100)),
        ("O1-2", "O1", "C1", "W1", D(2024, 1, 5), D(2024, 1, 9), "P2", "S2", 5, 4, m(20), m(2), m(80)),
        ("O2-1", "O2", "C2", "W2", D(2024, 2, 1), D(2024, 2, 4), "P1", "S1", 3, 3, m(10), m(1), m(30)),
    ],
    "tms_shipments": [
        ("T1", "O1", "A", "W1", D(2024, 1, 6), D(2024, 1, 9), D(2024, 1, 9), m(18), m(9), m(4), m(0), True),
        ("T2", "O2", "B", "W2", D(2024, 2, 2), D(2024, 2, 6), D(2024, 2, 4), m(3), m(5), m(4), m(7), False),
    ],
    "wms_inventory_snapshots": [(D(2024, 1, 1), "W1", "P1", 0, 2.0, Decimal("0.0000")), (D(2024, 1, 1), "W2", "P1", 9, 1.0, Decimal("9.5000"))],
    "demand_forecasts": [(D(2024, 1, 1), "W1", "P1", 9, 10), (D(2024, 1, 1), "W2", "P1", 5, 5)],
    "warehouse_activity": [(D(2024, 1, 1), "W1", 14, m(2)), (D(2024, 2, 1), "W2", 3, m(1))],
}


def sources(spark, **rows) -> Sources:
    schemas = source_schemas(T.StringType())
    return Sources(**{name: spark.createDataFrame({**CLEAN, **rows}[name], schemas[name]) for name in CLEAN})


def status(report):
    return {r.check: r.status for r in report.collect()}


def changed(table, row, **columns):
    names = source_schemas(T.StringType())[table].names
    out = [list(r) for r in CLEAN[table]]
    for name, value in columns.items():
        out[row][names.index(name)] = value
    return [tuple(r) for r in out]


def test_clean_sources_pass_all_checks(spark):
    got = status(FulfillmentModel(sources(spark)).data_quality_report)
    assert len(got) == 38 and set(got.values()) == {"PASS"}


DEFECTS = [
    ({"customers": CLEAN["customers"] + [("C1", "Retail", "US")], "suppliers": CLEAN["suppliers"] + [("S1", "One", 5, "Low")],
      "products": CLEAN["products"] + [CLEAN["products"][0]], "erp_order_lines": CLEAN["erp_order_lines"] + [CLEAN["erp_order_lines"][0]],
      "wms_inventory_snapshots": CLEAN["wms_inventory_snapshots"] * 2, "demand_forecasts": CLEAN["demand_forecasts"] * 2,
      "warehouse_activity": CLEAN["warehouse_activity"] * 2},
     {"customer_key_unique", "supplier_key_unique", "product_key_unique", "order_line_key_unique", "inventory_grain_unique",
      "forecast_grain_unique", "activity_grain_unique"}),
    ({"tms_shipments": CLEAN["tms_shipments"] + [CLEAN["tms_shipments"][0]]}, {"shipment_order_unique", "order_output_unique"}),
    ({"tms_shipments": changed("tms_shipments", 1, order_id="O9")},
     {"shipment_orders_exist", "order_shipment_coverage", "shipment_promise_matches_erp", "sql_python_reconciliation_passed"}),
    ({"erp_order_lines": changed("erp_order_lines", 2, customer_id="C9", sku="P9", supplier_id="S9", units_ordered=-3)},
     {"order_customers_exist", "order_products_exist", "order_suppliers_exist", "units_non_negative", "shipped_not_above_ordered"}),
    ({"erp_order_lines": changed("erp_order_lines", 2, promised_date=D(2024, 1, 1)),
      "tms_shipments": changed("tms_shipments", 0, ship_date=D(2024, 1, 20), on_time=False)},
     {"promised_not_before_order", "shipment_promise_matches_erp", "delivery_not_before_ship", "source_on_time_consistent"}),
    ({"wms_inventory_snapshots": changed("wms_inventory_snapshots", 1, inventory_value=Decimal("-1.0000")),
      "demand_forecasts": changed("demand_forecasts", 0, forecast_units=-1), "warehouse_activity": changed("warehouse_activity", 0, labor_hours=m(0))},
     {"inventory_non_negative", "forecast_non_negative", "activity_valid"}),
]


@pytest.mark.parametrize("rows,failing", DEFECTS)
def test_each_source_defect_fails_its_check(spark, rows, failing):
    got = status(FulfillmentModel(sources(spark, **rows)).data_quality_report)
    assert len(got) == 38
    assert failing <= {c for c, s in got.items() if s == "FAIL"}
    untouched = {"summary_metrics_complete", "summary_metric_unique", "carrier_output_non_empty"}
    assert {got[c] for c in untouched} == {"PASS"}


def report_with(spark, summary=None, carriers=None, reconciled=None):
    model = FulfillmentModel(sources(spark))
    s = model.src
    return status(ops.data_quality_report(
        s.customers, s.suppliers, s.products, s.erp_order_lines, s.tms_shipments, s.wms_inventory_snapshots, s.demand_forecasts,
        s.warehouse_activity, summary if summary is not None else model.kpi_summary, model.order_service,
        carriers if carriers is not None else model.carrier_scorecard, reconciled if reconciled is not None else model.reconcile_metrics))


def test_defects_of_the_outputs_fail_their_checks(spark):
    model = FulfillmentModel(sources(spark))
    summary = model.kpi_summary
    above = summary.withColumn("value", F.when(F.col("metric").isin(*ops.SUMMARY_METRICS[:5], *ops.SUMMARY_METRICS[6:8]), 1.5 + F.col("value")).otherwise(F.col("value")))
    got = report_with(spark, above, model.carrier_scorecard.limit(0), model.reconcile_metrics.limit(0))
    assert {c for c, s in got.items() if s == "FAIL"} >= {
        "unit_fill_rate_range", "complete_order_rate_range", "on_time_delivery_rate_range", "otif_rate_range", "backorder_rate_range",
        "forecast_accuracy_range", "stockout_rate_range", "stockout_rate_matches_demanded_inventory", "backorder_complements_fill",
        "carrier_output_non_empty", "sql_python_reconciliation_passed"}
    broken = summary.where("metric <> 'average_lead_time_days'").withColumn(
        "value", F.when(F.col("metric") == "otif_rate", 1.0).when(F.col("metric") == "total_cost_to_serve", float("nan")).otherwise(F.col("value")))
    got = report_with(spark, broken.union(broken.where("metric = 'unit_fill_rate'")))
    assert {c for c, s in got.items() if s == "FAIL"} >= {
        "summary_metric_unique", "summary_metrics_complete", "summary_values_finite", "otif_not_above_components"}


def test_duplicate_dimension_rows_raise(spark):
    model = FulfillmentModel(sources(spark, customers=CLEAN["customers"] + [("C1", "Retail", "US")],
                                     suppliers=CLEAN["suppliers"] + [("S1", "One", 5, "Low")]))
    for view in ("customer_cost_to_serve", "service_by_region_segment", "supplier_risk_scorecard", "supplier_line_shortage"):
        with pytest.raises(Exception, match="one-to-one join violated"):
            getattr(model, view).collect()


def test_duplicate_shipment_still_raises_in_the_service(spark):
    model = FulfillmentModel(sources(spark, tms_shipments=CLEAN["tms_shipments"] * 2))
    with pytest.raises(Exception, match="one-to-one join violated"):
        model.order_service.collect()


def test_grid_takes_any_warehouse_and_leaves_out_rows_without_a_cell(spark):
    lines = CLEAN["erp_order_lines"] + [
        ("X1", "O3", "C1", "W-NEW", D(2023, 11, 30), D(2024, 1, 1), "P2", "S2", 7, 7, m(1), m(1), m(7)),
        ("X2", "O4", "C1", "W1", None, None, "P1", "S1", 99, 1, m(1), m(1), m(1)),
        ("X3", "O5", "C1", None, D(2024, 1, 2), None, "P1", "S1", 98, 1, m(1), m(1), m(1)),
    ]
    src = sources(spark, erp_order_lines=lines)
    rows = ops.demand_grid(src.erp_order_lines, src.products).collect()
    got = {(r.month, r.warehouse, r.sku): r.demand_units for r in rows}
    assert len(rows) == len(got) == 4 * 3 * 2  # Nov 2023 - Feb 2024, three warehouses, two products
    assert {k: v for k, v in got.items() if v} == {
        (D(2024, 1, 1), "W1", "P1"): 10, (D(2024, 1, 1), "W1", "P2"): 5, (D(2024, 2, 1), "W2", "P1"): 3, (D(2023, 11, 1), "W-NEW", "P2"): 7}
    assert monthly_demand_grid(demand_cells(src.erp_order_lines.limit(0)), src.products).collect() == []


def test_empty_service_totals_are_zero(spark):
    model = FulfillmentModel(sources(spark, **{t: [] for t in ("erp_order_lines", "tms_shipments")}))
    got = {r.metric: r.value for r in model.kpi_summary.collect()}
    assert got["total_cost_to_serve"] == 0.0 and got["unit_fill_rate"] == 0.0


def test_queue_is_whole_and_ranked_only_on_request(spark):
    model = FulfillmentModel(sources(spark))
    assert {r.order_id: r.reason for r in model.exception_queue.collect()} == {"O1": "short", "O2": "late"}
    assert [(r.order_id, r.queue_rank) for r in ops.exception_queue(model.order_service, 1).collect()] == [("O1", 1)]
    assert [r.order_id for r in ops.exception_queue(model.order_service, ordered=True).collect()] == ["O1", "O2"]
    plan = model.exception_queue._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_filters_by_every_dimension(spark):
    model = FulfillmentModel(sources(spark))
    orders = lambda **f: sorted(r.order_id for r in model.filtered(ops.Filters(**f)).order_service.collect())
    assert orders(region=["EU"]) == ["O1"] and orders(customer_segment=["Pro"]) == ["O2"]
    assert orders(product_category=["A"]) == ["O1", "O2"] and orders(product_category=["B"]) == ["O1"]
    assert orders(supplier_id=["S2"]) == ["O1"] and orders(product_category=["A"], supplier_id=["S2"]) == []
    assert orders(warehouse=["W2"], carrier=["B"], date_from=D(2024, 1, 1)) == ["O2"] and orders(date_to=D(2024, 1, 31)) == ["O1"]
    view = model.filtered(ops.Filters(region=["US"])).service_by_region_segment.collect()
    assert [(r.region, r.orders) for r in view] == [("US", 1)]
    stock = lambda **f: [(r.warehouse, r.severity) for r in model.filtered(ops.Filters(**f)).stockout_exceptions.collect()]
    assert stock() == [("W1", "Critical")] and stock(severity=["High"]) == [] and stock(severity=["Critical"], product_category=["A"]) == [("W1", "Critical")]
    assert stock(product_category=["B"]) == [] and stock(supplier_id=["S1"], date_to=D(2023, 12, 31)) == []
    with pytest.raises(ValueError):
        model.filtered(ops.Filters(severity=["High"])).order_service
    with pytest.raises(ValueError):
        model.filtered(ops.Filters(carrier=["A"])).stockout_exceptions
    days = {r.lead_time_days: (r.p50_lead_time_days, r.p90_lead_time_days) for r in model.lead_time_distribution.collect()}
    assert days == {4: (4.5, pytest.approx(4.9)), 5: (4.5, pytest.approx(4.9))}
