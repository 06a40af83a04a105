"""Small builders for test frames with the reference's partial schemas."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("warehouse", T.StringType()), T.StructField("order_date", T.DateType()),
    T.StructField("promised_date", T.DateType()), T.StructField("units_ordered", T.LongType()),
    T.StructField("units_shipped", T.LongType()), T.StructField("revenue", T.DecimalType(18, 2)),
])
SHIPMENT_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("carrier", T.StringType()),
    T.StructField("delivery_date", T.DateType()), T.StructField("freight_cost", T.DecimalType(18, 2)),
    T.StructField("handling_cost", T.DecimalType(18, 2)), T.StructField("exception_cost", T.DecimalType(18, 2)),
    T.StructField("shipment_weight_kg", T.DecimalType(18, 2)),
])


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def orders(spark, rows):
    """rows: (order_id, customer, warehouse, order_date, promised_date, ordered, shipped, revenue)"""
    return spark.createDataFrame(
        [(o, c, w, d(od), d(pd), u, s, money(r)) for o, c, w, od, pd, u, s, r in rows], ORDER_SCHEMA
    )


def shipments(spark, rows):
    """rows: (order_id, carrier, delivery_date, freight, handling, exception, weight)"""
    return spark.createDataFrame(
        [(o, c, None if dd is None else d(dd), money(f), money(h), money(e), money(w))
         for o, c, dd, f, h, e, w in rows], SHIPMENT_SCHEMA
    )
