"""Dashboard views over the order service (O25-O27, O32-O37) and their filters.

Windows here run only over *grouped* rows (carriers, strata, lead-time days)
whose count does not grow with the order volume; order-level ordering is a
distributed sort or a top-k (``TakeOrderedAndProject``) where a queue is the
feature.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import (
    TOTAL_MONEY,
    flag_int,
    flag_rate,
    ratio,
)
from cargoline.operators.inventory import stockout_exceptions
from cargoline.operators.keys import one_row_per_key
from cargoline.operators.quantiles import percentile_cont
from cargoline.session import written_once

# Shipment weight bands (kg, right-closed) of the stratified carrier view.
WEIGHT_BANDS = (("0-100", 0.0, 100.0), ("100-500", 100.0, 500.0), ("500-1000", 500.0, 1000.0))
HEAVY_BAND = "1000+"
ZERO_BAND = "zero"


@dataclass(frozen=True)
class Filters:
    """Dashboard filters (O35).  Each set field becomes a predicate on the view;
    Catalyst pushes it through joins/aggregates to the parquet scan."""

    date_from: dt.date | None = None
    date_to: dt.date | None = None
    date_column: str = "order_date"
    region: Sequence[str] | None = None
    warehouse: Sequence[str] | None = None
    customer_segment: Sequence[str] | None = None
    product_category: Sequence[str] | None = None
    supplier_id: Sequence | None = None
    carrier: Sequence[str] | None = None
    severity: Sequence[str] | None = None

    def predicate(self, columns: Sequence[str]) -> Column | None:
        preds: list[Column] = []
        if self.date_from is not None:
            preds.append(F.col(self.date_column) >= F.lit(self.date_from))
        if self.date_to is not None:
            preds.append(F.col(self.date_column) <= F.lit(self.date_to))
        if self.date_column == "order_date" and "order_month" in columns:
            # the month partition column of materialised tables: prunes whole files
            if self.date_from is not None:
                preds.append(F.col("order_month") >= F.trunc(F.lit(self.date_from), "month"))
            if self.date_to is not None:
                preds.append(F.col("order_month") <= F.trunc(F.lit(self.date_to), "month"))
        for f in fields(self):
            if f.name in ("date_from", "date_to", "date_column"):
                continue
            values = getattr(self, f.name)
            if values is None:
                continue
            if f.name not in columns:
                raise ValueError(f"filter on {f.name!r} but the view has no such column")
            preds.append(F.col(f.name).isin(list(values)))
        if (self.date_from is not None or self.date_to is not None) and self.date_column not in columns:
            raise ValueError(f"date filter on {self.date_column!r} but the view has no such column")
        out = None
        for p in preds:
            out = p if out is None else out & p
        return out


def apply_filters(view: DataFrame, filters: Filters | None) -> DataFrame:
    if filters is None:
        return view
    pred = filters.predicate(view.columns)
    return view if pred is None else view.filter(pred)


def filter_orders(service: DataFrame, filters: Filters, customers: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """O35 on the order grain.  Columns of the order filter directly; region and segment
    keep orders of matching customers, category and supplier keep orders with at least one
    matching line (both on the same line).  All lookups are semi joins: rows never multiply.
    """
    if filters.severity is not None:
        raise ValueError("severity is a dimension of the stockout views")
    out = apply_filters(service, replace(filters, region=None, customer_segment=None, product_category=None, supplier_id=None))
    of_customer = Filters(region=filters.region, customer_segment=filters.customer_segment)
    if of_customer != Filters():
        out = out.join(apply_filters(customers, of_customer).select("customer_id"), "customer_id", "left_semi")
    if filters.product_category is not None or filters.supplier_id is not None:
        hit = apply_filters(lines.select("order_id", "sku", "supplier_id"), Filters(supplier_id=filters.supplier_id))
        if filters.product_category is not None:
            hit = hit.join(apply_filters(products, Filters(product_category=filters.product_category)).select("sku"), "sku", "left_semi")
        out = out.join(hit.select("order_id"), "order_id", "left_semi")
    return out.select(*service.columns)


def filter_stock(rows: DataFrame, filters: Filters, products: DataFrame, date_column: str) -> DataFrame:
    """O35 on location-SKU rows (snapshots, forecasts): dates, warehouse, and category and
    supplier of the product.  Severity belongs to the exceptions made of the rows."""
    for name in ("region", "customer_segment", "carrier"):
        if getattr(filters, name) is not None:
            raise ValueError(f"filter on {name!r} but stock has no such dimension")
    own = Filters(filters.date_from, filters.date_to, date_column, warehouse=filters.warehouse)
    out = apply_filters(rows, own)
    of_product = Filters(product_category=filters.product_category, supplier_id=filters.supplier_id)
    if of_product != Filters():
        out = out.join(apply_filters(products, of_product).select("sku"), "sku", "left_semi").select(*rows.columns)
    return out


def service_by_region_segment(service: DataFrame, customers: DataFrame) -> DataFrame:
    """OTIF, OTD and unit fill by customer region and segment.

    Orders are first folded per customer (partial aggregation collapses a hot
    customer before any shuffle), the per-customer sums join the customer
    dimension, and the sums roll up to region x segment, so the rates keep
    their natural numerators and denominators.
    """
    per_customer = service.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"),
        F.sum(flag_int("otif")).alias("_otif"), F.count("otif").alias("_otif_n"),
        F.sum(flag_int("on_time")).alias("_on_time"), F.count("on_time").alias("_on_time_n"),
        F.sum("units_shipped").alias("_shipped"), F.sum("units_ordered").alias("_ordered"),
        F.sum("cost_to_serve").cast(TOTAL_MONEY).alias("_cost"),
    )
    return (
        per_customer.join(one_row_per_key(customers, "customer_id", ["region", "customer_segment"]), "customer_id", "left")
        .groupBy("region", "customer_segment")
        .agg(
            F.sum("_orders").cast(T.LongType()).alias("orders"),
            ratio(F.sum("_otif"), F.sum("_otif_n")).alias("otif_rate"),
            ratio(F.sum("_on_time"), F.sum("_on_time_n")).alias("on_time_delivery_rate"),
            ratio(F.sum("_shipped"), F.sum("_ordered")).alias("unit_fill_rate"),
            F.sum("_cost").cast(TOTAL_MONEY).alias("cost_to_serve"),
        )
    )


def carrier_quadrant(service: DataFrame, carriers: DataFrame) -> DataFrame:
    """Each carrier against the portfolio's OTIF and average freight per kg.

    ``carriers`` is the carrier scorecard (O6); the portfolio is a one-row
    aggregate over the same shipped orders, joined by a one-row broadcast.
    """
    shipped = service.filter(F.col("carrier").isNotNull())
    portfolio = shipped.agg(
        flag_rate("otif").alias("portfolio_otif_rate"),
        F.avg("freight_cost_per_kg").alias("portfolio_freight_cost_per_kg"),
    )
    good_service = F.col("otif_rate") >= F.col("portfolio_otif_rate")
    low_cost = F.col("average_freight_cost_per_kg") <= F.col("portfolio_freight_cost_per_kg")
    quadrant = (
        F.when(good_service & low_cost, "high service / low cost")
        .when(good_service & ~low_cost, "high service / high cost")
        .when(~good_service & low_cost, "low service / low cost")
        .when(~good_service & ~low_cost, "low service / high cost")
    )
    return (
        carriers.select("carrier", "orders", "otif_rate", "average_freight_cost_per_kg")
        .crossJoin(F.broadcast(portfolio))
        .withColumn("quadrant", quadrant)
    )


def exception_queue(service: DataFrame, k: int | None = None, ordered: bool = False) -> DataFrame:
    """The non-OTIF orders with the reason (late, short or both).

    The queue's priority is backorder units, then cost, then order id.  By default every
    order is returned, in no order (``ordered=True`` adds a distributed sort).  With ``k``
    the first k are returned with their ``queue_rank``; its window runs over k rows.
    """
    late = ~F.col("on_time")
    short = ~F.col("in_full")
    reason = F.when(late & short, "both").when(late, "late").otherwise("short")
    order = [F.col("backorder_units").desc_nulls_last(), F.col("cost_to_serve").desc_nulls_last(),
             F.col("order_id").asc_nulls_last()]
    queue = service.filter(~F.col("otif")).select(
        "order_id", "customer_id", "warehouse", "carrier", "order_date", "promised_date", "delivery_date",
        "units_ordered", "units_shipped", "backorder_units", "cost_to_serve", reason.alias("reason"))
    if k is None:
        return queue.orderBy(*order) if ordered else queue
    top = queue.orderBy(*order).limit(k)
    return top.withColumn("queue_rank", F.row_number().over(Window.partitionBy().orderBy(*order)).cast(T.LongType()))


def freight_per_kg_by_carrier(service: DataFrame, p90_method: str = "exact") -> DataFrame:
    """Freight cost per kg by carrier over shipments with a known weight:
    ratio of sums, mean of per-order ratios and the exact 90th percentile."""
    weighed = service.filter(F.col("carrier").isNotNull() & (F.col("shipment_weight_kg") > 0))
    aggs = [
        F.count(F.lit(1)).cast(T.LongType()).alias("shipments"),
        F.sum("freight_cost").cast(TOTAL_MONEY).alias("freight_cost"),
        F.sum("shipment_weight_kg").cast(TOTAL_MONEY).alias("shipment_weight_kg"),
        F.avg("freight_cost_per_kg").alias("average_freight_cost_per_kg"),
    ]
    out = percentile_cont(weighed, ["carrier"], "freight_cost_per_kg", 0.9, "p90_freight_cost_per_kg", p90_method,
                          extra=aggs)
    return out.withColumn("freight_cost_per_kg", ratio("freight_cost", "shipment_weight_kg"))


def lead_time_distribution(service: DataFrame) -> DataFrame:
    """Orders per lead-time day with share and cumulative share, and the exact median
    and 90th percentile (continuous) of all lead times on every row.

    Everything after the first aggregate runs over one row per day: the value at rank r is
    the first day whose cumulative count exceeds r.
    """
    per_day = service.filter(F.col("lead_time_days").isNotNull()).groupBy("lead_time_days").agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("orders")
    )
    everything = Window.partitionBy()
    total = F.sum("orders").over(everything)
    running = F.sum("orders").over(
        everything.orderBy("lead_time_days").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    days = per_day.select("lead_time_days", "orders", total.alias("_n"), running.alias("_to"))

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("_to") > rank, F.col("lead_time_days"))).over(everything).cast("double")

    def percentile(p: float) -> Column:
        place = (F.col("_n") - 1).cast("double") * F.lit(p)
        low, high = at_rank(F.floor(place)), at_rank(F.ceil(place))
        return low + (place - F.floor(place)) * (high - low)

    return days.select("lead_time_days", "orders", ratio("orders", "_n").alias("share"),
                       F.col("_to").cast(T.LongType()).alias("cumulative_orders"),
                       ratio("_to", "_n").alias("cumulative_share"),
                       percentile(0.5).alias("p50_lead_time_days"), percentile(0.9).alias("p90_lead_time_days"))


def exception_cost_pareto(service: DataFrame, by: str = "carrier") -> DataFrame:
    """Exception cost by ``by`` (carrier or warehouse), largest first, with
    cumulative share; the window runs over the grouped rows."""
    grouped = service.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.sum("exception_cost").cast(TOTAL_MONEY).alias("exception_cost"),
        F.count_if(F.col("exception_cost") > 0).cast(T.LongType()).alias("orders_with_exception"),
    )
    order = [F.col("exception_cost").desc_nulls_last(), F.col(by).asc()]
    w_all = Window.partitionBy()
    running = F.sum("exception_cost").over(w_all.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("exception_cost").over(w_all)
    return grouped.select(
        by, "exception_cost", "orders_with_exception",
        ratio(F.col("exception_cost"), total).alias("share"),
        ratio(running, total).alias("cumulative_share"),
        F.row_number().over(w_all.orderBy(*order)).cast(T.LongType()).alias("pareto_rank"),
    )


def weight_band(weight: str | Column) -> Column:
    w = F.col(weight) if isinstance(weight, str) else weight
    expr = F.when(w.isNull() | (w <= 0), ZERO_BAND)
    for label, lo, hi in WEIGHT_BANDS:
        expr = expr.when((w > lo) & (w <= hi), label)
    return expr.otherwise(HEAVY_BAND)


def carrier_stratified(service: DataFrame) -> DataFrame:
    """Carriers compared within strata of warehouse x weight band.

    OTIF and freight per kg per (warehouse, band, carrier) and their difference
    to the stratum value with natural weights (orders, kg); the stratum window
    runs over the grouped rows.
    """
    shipped = service.filter(F.col("carrier").isNotNull()).withColumn("weight_band", weight_band("shipment_weight_kg"))
    weighed = F.col("shipment_weight_kg") > 0
    cells = shipped.groupBy("warehouse", "weight_band", "carrier").agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("orders"),
        F.sum(flag_int("otif")).cast(T.LongType()).alias("otif_orders"),
        F.sum(F.when(weighed, F.col("freight_cost"))).cast(TOTAL_MONEY).alias("freight_cost"),
        F.sum(F.when(weighed, F.col("shipment_weight_kg"))).cast(TOTAL_MONEY).alias("shipment_weight_kg"),
    )
    stratum = Window.partitionBy("warehouse", "weight_band")
    s_otif = ratio(F.sum("otif_orders").over(stratum), F.sum("orders").over(stratum))
    s_fpk = ratio(F.sum("freight_cost").over(stratum), F.sum("shipment_weight_kg").over(stratum))
    return cells.select(
        "warehouse", "weight_band", "carrier", "orders",
        ratio("otif_orders", "orders").alias("otif_rate"),
        ratio("freight_cost", "shipment_weight_kg").alias("freight_cost_per_kg"),
        s_otif.alias("stratum_otif_rate"),
        s_fpk.alias("stratum_freight_cost_per_kg"),
    ).withColumn("otif_vs_stratum", F.col("otif_rate") - F.col("stratum_otif_rate")) \
     .withColumn("freight_per_kg_vs_stratum", F.col("freight_cost_per_kg") - F.col("stratum_freight_cost_per_kg"))


#: small sides of the semi joins of O37 (a date and two keys, or a customer, a row) that are broadcast
BROADCAST_ROWS = 200_000


def _checked(rows: DataFrame) -> DataFrame:
    """``rows`` written, with a broadcast hint if they are few and short."""
    rows = written_once(rows)
    bulk = sum((F.octet_length(F.col(c).cast("string")) for c in rows.columns), F.lit(0))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(bulk).alias("bytes")).first()
    return F.broadcast(rows) if size.n <= BROADCAST_ROWS and (size.bytes or 0) <= 64 * BROADCAST_ROWS else rows


def critical_stockout_customers(
    inventory: DataFrame, lines: DataFrame, customers: DataFrame, revenue_percentile: float = 0.9,
    p_method: str = "exact",
) -> DataFrame:
    """High-revenue customers (revenue >= the p-th percentile over
    customers) whose order lines hit a Critical stockout of the same month,
    warehouse and SKU.

    Revenue by customer is written once, for the percentile and its threshold.  Semi joins keep the
    lines; no pair expansion.  Critical cells and top customers are few beside the lines: each
    is broadcast where its size allows, so that the scan's tasks filter the lines before
    anything moves, and joined by a shuffle beyond.  Top customers come first, as they
    leave the fewest lines.
    """
    revenue = written_once(lines.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("revenue").cast(TOTAL_MONEY).alias("customer_revenue")
    ), "customer-revenue")
    threshold = percentile_cont(revenue, [], "customer_revenue", revenue_percentile, "revenue_threshold", p_method).first()
    value = F.lit(threshold.revenue_threshold if threshold else None).cast("double")  # without revenue nobody is on top
    top = revenue.filter(F.col("customer_revenue").cast("double") >= value)
    critical = (
        stockout_exceptions(inventory)
        .filter(F.col("severity") == "Critical")
        .select(F.col("snapshot_date").alias("month"), "warehouse", "sku")
    )
    hit = (
        lines.withColumn("month", F.trunc("order_date", "month"))
        .join(_checked(top.select("customer_id")), "customer_id", "left_semi")
        .join(_checked(critical), ["month", "warehouse", "sku"], "left_semi")
    )
    return (
        hit.groupBy("customer_id").agg(
            F.count(F.lit(1)).cast(T.LongType()).alias("critical_lines"),
            F.countDistinct("order_id").cast(T.LongType()).alias("critical_orders"),
            F.sum("units_ordered").cast(T.LongType()).alias("critical_units_ordered"),
            F.sum(F.greatest(F.col("units_ordered") - F.col("units_shipped"), F.lit(0))).cast(T.LongType())
            .alias("critical_units_short"),
        )
        .join(top.withColumn("revenue_threshold", value), "customer_id")
        .join(one_row_per_key(customers, "customer_id", ["customer_segment", "region"]), "customer_id", "left")
    )
