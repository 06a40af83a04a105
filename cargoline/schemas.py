"""Explicit schemas of the eight fulfillment source tables.

Ids are STRING when read from the ERP/TMS/WMS extracts; the adapter over the
driver's TPC-H-like tables yields BIGINT ids.  Money and weight are
DECIMAL(18,2), counts BIGINT, dates DATE, rates DOUBLE.
"""
from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def source_schemas(id_type: T.DataType = T.StringType()) -> dict[str, T.StructType]:
    """Schemas keyed by source table name; ``id_type`` is the type of every id column."""
    s = T.StringType()
    return {
        "customers": _struct(("customer_id", id_type), ("customer_segment", s), ("region", s)),
        "suppliers": _struct(
            ("supplier_id", id_type), ("supplier_name", s),
            ("base_lead_time_days", T.IntegerType()), ("supplier_risk_tier", s),
        ),
        "products": _struct(
            ("sku", id_type), ("product_category", s), ("supplier_id", id_type),
            ("unit_price", MONEY), ("unit_weight_kg", MONEY),
        ),
        "erp_order_lines": _struct(
            ("order_line_id", s), ("order_id", id_type), ("customer_id", id_type), ("warehouse", s),
            ("order_date", T.DateType()), ("promised_date", T.DateType()),
            ("sku", id_type), ("supplier_id", id_type),
            ("units_ordered", T.LongType()), ("units_shipped", T.LongType()),
            ("unit_price", MONEY), ("unit_weight_kg", MONEY), ("revenue", MONEY),
        ),
        "tms_shipments": _struct(
            ("shipment_id", id_type), ("order_id", id_type), ("carrier", s), ("warehouse", s),
            ("ship_date", T.DateType()), ("delivery_date", T.DateType()), ("promised_date", T.DateType()),
            ("shipment_weight_kg", MONEY), ("freight_cost", MONEY), ("handling_cost", MONEY),
            ("exception_cost", MONEY), ("on_time", T.BooleanType()),
        ),
        "wms_inventory_snapshots": _struct(
            ("snapshot_date", T.DateType()), ("warehouse", s), ("sku", id_type),
            ("on_hand_units", T.LongType()), ("average_daily_demand", T.DoubleType()),
            ("inventory_value", T.DecimalType(18, 4)),
        ),
        "demand_forecasts": _struct(
            ("month", T.DateType()), ("warehouse", s), ("sku", id_type),
            ("forecast_units", T.LongType()), ("actual_units", T.LongType()),
        ),
        "warehouse_activity": _struct(
            ("activity_date", T.DateType()), ("warehouse", s),
            ("units_processed", T.LongType()), ("labor_hours", MONEY),
        ),
    }


SOURCE_TABLES = tuple(source_schemas())
