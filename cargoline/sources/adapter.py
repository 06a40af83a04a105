"""Adapter: the driver's TPC-H-like tables -> the eight fulfillment sources.

The driver supplies ``lineitem orders part supplier customer nation region``.
Every source column is a deterministic integer rule over those tables so that
an independent SQL engine can compute the same tables (see
``cargoline.plans.oracle``).  Ids stay BIGINT.  Money is built from integer
cents multiplied by 0.01 -- never by dividing decimals.

Scale notes
* order lines = lineitem JOIN orders JOIN part: two shuffled equi-joins
  (AQE turns either into a broadcast join at runtime when that side is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``); every later order-level
  step groups on ``order_id = l_orderkey`` and reuses that partitioning.
* nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions: the
  only explicit broadcasts here.
* The inventory/forecast grid is months x warehouses x parts.  The lines are read once
  for its cells, which are written on first use; the dense rows are never shuffled
  (``cargoline.operators.demand``).
"""
from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import MONEY, cents_to_money
from cargoline.operators.demand import demand_cells, monthly_demand_grid
from cargoline.session import written_once
from cargoline.sources.readers import Sources

DRIVER_TABLES = ("lineitem", "orders", "part", "supplier", "customer", "nation", "region")

# Fixed values of the adapter (shared with the SQL oracle).
WAREHOUSES = ("WH-NORTH", "WH-CENTRAL", "WH-SOUTH")  # by o_orderkey % 3
CARRIER_WHEEL = "AAABBBCCDD"  # carrier = character (o_orderkey % 10) + 1
PROMISE_DAYS = {"1-URGENT": 2, "2-HIGH": 3, "5-LOW": 7}  # any other priority: 5
DEFAULT_PROMISE_DAYS = 5
OPEN_ORDER_MOD, OPEN_ORDER_REST = 40, 7  # o_orderkey % 40 = 7 has no shipment
SHORT_SHIP_MOD = 31  # a line ships short when (7 partkey + 3 suppkey + linenumber) % 31 = 0


def _warehouse(orderkey: Column) -> Column:
    m = orderkey % 3
    return F.when(m == 0, WAREHOUSES[0]).when(m == 1, WAREHOUSES[1]).otherwise(WAREHOUSES[2])


def _promise_days(priority: Column) -> Column:
    expr = None
    for name, days in PROMISE_DAYS.items():
        expr = F.when(priority == name, days) if expr is None else expr.when(priority == name, days)
    return expr.otherwise(DEFAULT_PROMISE_DAYS)


def _order_headers(orders: DataFrame) -> DataFrame:
    """Order-level header values shared by ERP lines and TMS shipments."""
    order_date = F.col("o_orderdate").cast(T.DateType())
    return orders.select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        _warehouse(F.col("o_orderkey")).alias("warehouse"),
        order_date.alias("order_date"),
        F.date_add(order_date, _promise_days(F.col("o_orderpriority"))).alias("promised_date"),
    )


def erp_order_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """ERP order lines: lineitem x part x orders with the adapter's rules."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    # the decimals of a part are made once a part, not once a line
    p = part.select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("unit_price"), cents_to_money(F.col("p_size") * 25).alias("unit_weight_kg"))
    ordered = F.col("l_quantity").cast(T.LongType())
    short = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + F.col("l_linenumber")) % SHORT_SHIP_MOD == 0
    shipped = F.when(short, F.expr("(cast(l_quantity as bigint) * (l_partkey % 4)) div 4")).otherwise(ordered)
    return (
        # part first, then orders: the result stays hash-partitioned on
        # l_orderkey, which every order-level aggregate downstream reuses
        li.join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(_order_headers(orders), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_line_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "warehouse",
            "order_date",
            "promised_date",
            F.col("l_partkey").alias("sku"),
            F.col("l_suppkey").alias("supplier_id"),
            ordered.alias("units_ordered"),
            shipped.alias("units_shipped"),
            "unit_price",
            "unit_weight_kg",
            (shipped * F.col("unit_price")).cast(MONEY).alias("revenue"),
        )
    )


def tms_shipments(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One shipment per order except the open orders; weight and freight from
    the order's shipped units.  ``wq`` = sum of shipped units x part size =
    sum of shipped units x unit weight x 4 (unit weight is size / 4), so the
    shipments derive from the order-line source itself -- no second pass over
    the raw line items."""
    wq = lines.groupBy("order_id").agg(
        F.sum(F.col("units_shipped") * F.col("unit_weight_kg") * 4).cast(T.LongType()).alias("wq")
    )
    heads = _order_headers(orders.filter(F.col("o_orderkey") % OPEN_ORDER_MOD != OPEN_ORDER_REST))
    h = (F.col("o_orderkey") * 13 + F.col("o_custkey") * 7) % 25
    delay = (
        F.when(h == 0, -1).when(h <= 17, 0).when(h <= 20, 1).when(h <= 22, 2).when(h == 23, 3).otherwise(5)
    )
    ship_date = F.date_add("order_date", (F.col("o_custkey") % 4).cast("int"))
    delivery = F.greatest(F.date_add("promised_date", delay), ship_date)
    wq_col = F.coalesce(F.col("wq"), F.lit(0))
    return (
        heads.join(wq, heads.o_orderkey == wq.order_id, "left")
        .withColumn("delivery_date", delivery)
        .select(
            F.col("o_orderkey").alias("shipment_id"),
            F.col("o_orderkey").alias("order_id"),
            F.substring(F.lit(CARRIER_WHEEL), (F.col("o_orderkey") % 10 + 1).cast("int"), 1).alias("carrier"),
            "warehouse",
            ship_date.alias("ship_date"),
            "delivery_date",
            "promised_date",
            cents_to_money(wq_col * 25).alias("shipment_weight_kg"),
            cents_to_money(wq_col * (F.col("o_orderkey") % 13 + 9) + 2400).alias("freight_cost"),
            cents_to_money(F.col("o_custkey") % 1400 + 400).alias("handling_cost"),
            cents_to_money(
                F.when(F.col("delivery_date") > F.col("promised_date"), F.col("o_orderkey") % 5500 + 500).otherwise(0)
            ).alias("exception_cost"),
            (F.col("delivery_date") <= F.col("promised_date")).alias("on_time"),
        )
    )


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = F.broadcast(
        nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    )
    return customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("r_name").alias("region"),
    )


def suppliers(supplier: DataFrame) -> DataFrame:
    m = F.col("s_suppkey") % 20
    return supplier.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        (F.col("s_suppkey") % 17 + 5).cast(T.IntegerType()).alias("base_lead_time_days"),
        F.when(m < 11, "Low").when(m < 17, "Medium").otherwise("High").alias("supplier_risk_tier"),
    )


def products(part: DataFrame, supplier: DataFrame) -> DataFrame:
    n_sup = supplier.agg(F.count(F.lit(1)).alias("n_suppliers"))  # one row
    return part.crossJoin(F.broadcast(n_sup)).select(
        F.col("p_partkey").alias("sku"),
        F.col("p_type").alias("product_category"),
        (F.col("p_partkey") % F.col("n_suppliers")).alias("supplier_id"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        cents_to_money(F.col("p_size") * 25).alias("unit_weight_kg"),
    )


def wms_inventory_snapshots(grid: DataFrame) -> DataFrame:
    m = F.month("month")
    cents = (F.col("unit_price") * 100).cast(T.LongType())
    on_hand = F.greatest(
        F.lit(0),
        F.expr("(demand * (5 + (7 * sku + month(month)) % 20)) div days_in_month") + (F.col("sku") + m * 11) % 17 - 8,
    )
    value_units = (F.col("on_hand_units") * cents * 55).cast(T.DecimalType(30, 0))
    return (
        grid.withColumn("on_hand_units", on_hand.cast(T.LongType()))
        .select(
            F.col("month").alias("snapshot_date"),
            "warehouse",
            "sku",
            "on_hand_units",
            (F.col("demand") / F.col("days_in_month")).alias("average_daily_demand"),
            (value_units * F.lit(0.0001).cast(T.DecimalType(4, 4))).cast(T.DecimalType(18, 4)).alias("inventory_value"),
        )
    )


def demand_forecasts(grid: DataFrame) -> DataFrame:
    m = F.month("month")
    shock = m.isin(9, 10) & (F.col("sku") % 10).isin(7, 8, 9)
    factor = (F.col("sku") * 31 + m * 17) % 37 + 82
    # floor(demand * factor / 100 * shock) with shock 1.8 or 1.0, in integers
    scaled = (F.col("demand") * factor * F.when(shock, 18).otherwise(10)).cast(T.LongType())
    return grid.withColumn("_scaled", scaled).select(
        "month", "warehouse", "sku",
        F.expr("_scaled div 1000").alias("forecast_units"),
        F.col("demand").cast(T.LongType()).alias("actual_units"),
    )


def warehouse_activity(lines: DataFrame) -> DataFrame:
    """Units shipped and labor hours per month and warehouse over the whole
    calendar span (months without orders process 0 units)."""
    shipped = lines.groupBy(F.trunc("order_date", "month").alias("month"), "warehouse").agg(
        F.sum("units_shipped").alias("units")
    )
    span = shipped.agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    cal = span.select(
        F.explode(F.sequence("first_month", "last_month", F.expr("interval 1 month"))).alias("month"),
    ).select("month", F.explode(F.array(*[F.lit(w) for w in WAREHOUSES])).alias("warehouse"))
    units = F.coalesce(F.col("units"), F.lit(0))
    return cal.join(shipped, ["month", "warehouse"], "left").select(
        F.col("month").alias("activity_date"),
        "warehouse",
        units.cast(T.LongType()).alias("units_processed"),
        F.greatest(F.lit(80), F.expr("coalesce(units, 0) div (18 + month(month))")).cast(MONEY).alias("labor_hours"),
    )


class TpchSources(Sources):
    """The eight sources over the driver's tables, each built on first use
    (only the driver tables a query needs are read and analysed)."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107 - no dataclass init
        self._spark, self._dir, self._tables = spark, sf_dir, {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(os.path.join(self._dir, f"{name}.parquet"))
        return self._tables[name]

    @cached_property
    def erp_order_lines(self) -> DataFrame:
        return erp_order_lines(self.table("lineitem"), self.table("orders"), self.table("part"))

    @cached_property
    def tms_shipments(self) -> DataFrame:
        return tms_shipments(self.erp_order_lines, self.table("orders"))

    def rebase(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. the written copy) for table ``name``; tables not
        built yet derive from it."""
        self.__dict__[name] = df

    def intermediates(self) -> list[str]:
        return ["demand_grid"]  # inventory snapshots and forecasts share it

    def projections(self) -> list[str]:
        return ["wms_inventory_snapshots", "demand_forecasts"]  # row-wise over the grid

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.table("customer"), self.table("nation"), self.table("region"))

    @cached_property
    def suppliers(self) -> DataFrame:
        return suppliers(self.table("supplier"))

    @cached_property
    def products(self) -> DataFrame:
        return products(self.table("part"), self.table("supplier"))

    @cached_property
    def demand_cells(self) -> DataFrame:
        return written_once(demand_cells(self.erp_order_lines), "demand-cells")

    @cached_property
    def demand_grid(self) -> DataFrame:
        return monthly_demand_grid(self.demand_cells, self.products)

    @cached_property
    def wms_inventory_snapshots(self) -> DataFrame:
        return wms_inventory_snapshots(self.demand_grid)

    @cached_property
    def demand_forecasts(self) -> DataFrame:
        return demand_forecasts(self.demand_grid)

    @cached_property
    def warehouse_activity(self) -> DataFrame:
        return warehouse_activity(self.erp_order_lines)


def from_tpch(spark: SparkSession, sf_dir: str) -> Sources:
    """The eight sources (lazily) over the driver's parquet tables."""
    return TpchSources(spark, sf_dir)
