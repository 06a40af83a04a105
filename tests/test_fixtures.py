"""Values probed independently for the adapter at sf0.01 (FIXTURES section 3)."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cargoline.plans.model import FulfillmentModel
from cargoline.sources.adapter import from_tpch

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no sf0.01 data")
    return FulfillmentModel(from_tpch(spark, SF_DIR))


def test_service_kpis(model):
    mart = model.mart_kpi_summary.collect()[0]
    assert mart.total_orders == 14743
    assert mart.unit_fill_rate == 0.9790189189277853
    assert mart.complete_order_rate == 0.8741097469985756
    assert mart.on_time_delivery_rate == 0.6840128008904968
    assert mart.otif_rate == 0.5953156399417919
    assert str(mart.total_cost_to_serve) == "6233863.53"
    frame = {r.metric: r.value for r in model.kpi_summary.collect()}
    assert frame["otif_rate"] == 0.5827172217323475


def test_open_orders_segments_and_carrier_p90(model):
    svc = model.order_service
    assert svc.filter(F.col("carrier").isNull()).count() == 369
    assert svc.filter(F.col("shipment_weight_kg") == 0).count() == 9
    seg = {(r.in_full, r.on_time): r.orders for r in model.service_segments.collect()}
    assert seg == {(False, False): 615, (False, True): 1241, (True, False): 4296, (True, True): 8591}
    a = model.mart_carrier_scorecard.filter("carrier = 'A'").collect()[0]
    assert a.orders == 4428 and round(a.p90_freight_cost_per_kg, 6) == 0.883808


def test_supplier_risk_and_backorder_attribution(model):
    top = model.supplier_risk_scorecard.orderBy(F.desc("resilience_risk_score")).first()
    assert (top.supplier_id, top.orders, top.backorder_units, top.supplier_risk_tier) == (39, 614, 1962, "High")
    assert round(top.resilience_risk_score, 6) == 0.557169
    short = model.supplier_line_shortage.agg(
        F.sum("attributed_backorder_units").alias("attributed"), F.sum("line_backorder_units").alias("by_line")
    ).collect()[0]
    actual = model.order_service.agg(F.sum("backorder_units")).collect()[0][0]
    assert (short.attributed, actual, short.by_line) == (155369, 31978, 31978)


def test_source_defects(model):
    lines, ships = model.src.erp_order_lines, model.src.tms_shipments
    repeated_ids = lines.groupBy("order_line_id").count().filter("count > 1").count()
    assert repeated_ids == 11785  # line ids that occur more than once
    assert ships.join(lines.select("order_id").distinct(), "order_id", "left_anti").count() == 251
