"""Carrier, customer and supplier scorecards.

Grouping keys with few values (carrier, supplier tier) are hot by nature: the
aggregates are all partial-aggregatable, so each task folds its rows before a
tiny exchange and no hot key ever lands whole in one task.  Ranks run only
over the grouped rows (one row per carrier), never over orders.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import (
    RISK_WEIGHTS,
    TOTAL_MONEY,
    clip,
    flag_int,
    flag_rate,
    ratio,
    tier_penalty,
)
from cargoline.operators.keys import one_row_per_key
from cargoline.operators.quantiles import percentile_cont


def _avg_exact(c: str):
    """Average of a decimal/integer column from its exact sum (DOUBLE)."""
    return ratio(F.sum(c), F.count(c))


def carrier_scorecard(service: DataFrame) -> DataFrame:
    """Per-carrier service and cost (dataframe policy; NULL carrier dropped),
    sorted by OTIF desc then freight per kg asc."""
    return (
        service.filter(F.col("carrier").isNotNull())
        .groupBy("carrier")
        .agg(
            F.count("order_id").cast(T.LongType()).alias("orders"),
            flag_rate("otif").alias("otif_rate"),
            flag_rate("on_time").alias("on_time_delivery_rate"),
            _avg_exact("lead_time_days").alias("average_lead_time_days"),
            _avg_exact("freight_cost").alias("average_freight_cost"),
            F.avg("freight_cost_per_kg").alias("average_freight_cost_per_kg"),
            F.coalesce(F.sum("exception_cost"), F.lit(0)).cast(TOTAL_MONEY).alias("total_exception_cost"),
        )
        .orderBy(F.col("otif_rate").desc_nulls_last(), F.col("average_freight_cost_per_kg").asc_nulls_last(), "carrier")
    )


def mart_carrier_scorecard(mart: DataFrame, p90_method: str = "exact") -> DataFrame:
    """Per carrier including the NULL carrier of open orders, with exact
    p90 freight per kg and dense service / cost ranks."""
    metrics = [
        F.count(F.lit(1)).cast(T.LongType()).alias("orders"),
        ratio(F.sum(flag_int("otif")), F.count("otif")).alias("otif_rate"),
        ratio(F.sum(flag_int("on_time")), F.count("on_time")).alias("on_time_delivery_rate"),
        _avg_exact("lead_time_days").alias("average_lead_time_days"),
        F.avg("freight_cost_per_kg").alias("average_freight_cost_per_kg"),
        F.sum("exception_cost").cast(TOTAL_MONEY).alias("total_exception_cost"),
    ]
    # the scorecard aggregates ride along in the percentile's first pass
    scored = percentile_cont(
        mart, ["carrier"], "freight_cost_per_kg", 0.9, "p90_freight_cost_per_kg", p90_method, extra=metrics
    )
    over_carriers = Window.partitionBy()  # one row per carrier: a handful of rows
    return scored.select(
        "*",
        F.dense_rank().over(over_carriers.orderBy(F.col("otif_rate").desc_nulls_last())).cast(T.LongType()).alias("service_rank"),
        F.dense_rank().over(over_carriers.orderBy(F.col("average_freight_cost_per_kg").asc_nulls_last()))
        .cast(T.LongType()).alias("cost_rank"),
    )


def customer_cost_to_serve(service: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer orders, revenue, cost, OTIF, backorders and cost share of
    revenue, with segment and region; sorted by cost share desc."""
    per_customer = service.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("order_id").cast(T.LongType()).alias("orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(TOTAL_MONEY).alias("revenue"),
        F.coalesce(F.sum("cost_to_serve"), F.lit(0)).cast(TOTAL_MONEY).alias("cost_to_serve"),
        flag_rate("otif").alias("otif_rate"),
        F.sum("backorder_units").cast(T.LongType()).alias("backorder_units"),
    )
    share = F.when(F.col("revenue") > 0, ratio("cost_to_serve", "revenue"))
    return (
        per_customer.withColumn("cost_to_serve_pct_revenue", share)
        .join(one_row_per_key(customers, "customer_id", ["customer_segment", "region"]), "customer_id", "left")
        .orderBy(F.col("cost_to_serve_pct_revenue").desc_nulls_last(), "customer_id")
    )


def _supplier_orders(lines: DataFrame, service: DataFrame) -> DataFrame:
    """Distinct (order, supplier) pairs carrying the order's OTIF and backorder.

    Pairs are formed first (partial aggregation collapses the lines of a hot
    order or supplier before any shuffle); only then are they joined to the
    order service, whose side has one row per order, so no join task ever
    holds a hot order's lines.
    """
    pairs = (
        lines.select("order_id", "supplier_id")
        .filter(F.col("order_id").isNotNull() & F.col("supplier_id").isNotNull())
        .groupBy("order_id", "supplier_id")
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    return pairs.join(
        service.select("order_id", flag_int("otif").alias("otif"), "backorder_units"), "order_id", "left"
    ).drop("_lines")


def supplier_risk_scorecard(lines: DataFrame, suppliers: DataFrame, service: DataFrame,
                            once: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Supplier resilience risk.

    Each order's OTIF and backorder are attributed to every supplier on the
    order (as in the reference).  score = clip(0.60 (1 - otif) + 0.25 *
    backorder / max(max backorder, 1) + 0.15 * tier penalty, 0, 1).
    ``once`` may write the per-supplier frame, which is read twice.
    """
    w_service, w_backorder, w_tier = RISK_WEIGHTS
    per_supplier = _supplier_orders(lines, service).groupBy("supplier_id").agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("orders"),
        ratio(F.sum("otif"), F.count("otif")).alias("otif_rate"),
        F.sum("backorder_units").cast(T.LongType()).alias("backorder_units"),
    )
    scored = per_supplier.join(one_row_per_key(suppliers, "supplier_id"), "supplier_id", "left")
    scored = once(scored)  # read twice: for the scores and for the largest backorder
    top = scored.agg(F.max("backorder_units").alias("_max_backorder"))  # one row
    norm = ratio(F.col("backorder_units"), F.greatest(F.col("_max_backorder"), F.lit(1)))
    score = clip(
        F.lit(w_service) * (F.lit(1.0) - F.col("otif_rate")) + F.lit(w_backorder) * norm
        + F.lit(w_tier) * tier_penalty("supplier_risk_tier"),
        0.0, 1.0,
    )
    return (
        scored.crossJoin(F.broadcast(top))
        .withColumn("resilience_risk_score", score)
        .drop("_max_backorder")
        .orderBy(F.col("resilience_risk_score").desc_nulls_last(), "supplier_id")
    )


def supplier_line_shortage(lines: DataFrame, suppliers: DataFrame, service: DataFrame) -> DataFrame:
    """Units actually short on each supplier's own lines, beside the
    order-attributed backorder total of O11."""
    own = lines.filter(F.col("supplier_id").isNotNull()).groupBy("supplier_id").agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("order_lines"),
        F.sum("units_ordered").cast(T.LongType()).alias("units_ordered"),
        F.sum("units_shipped").cast(T.LongType()).alias("units_shipped"),
        F.sum(F.greatest(F.col("units_ordered") - F.col("units_shipped"), F.lit(0))).cast(T.LongType())
        .alias("line_backorder_units"),
    )
    attributed = _supplier_orders(lines, service).groupBy("supplier_id").agg(
        F.sum("backorder_units").cast(T.LongType()).alias("attributed_backorder_units")
    )
    return (
        own.join(attributed, "supplier_id", "left")
        .join(one_row_per_key(suppliers, "supplier_id", ["supplier_name", "supplier_risk_tier"]), "supplier_id", "left")
        .withColumn("attribution_ratio", ratio("attributed_backorder_units", "line_backorder_units"))
    )
