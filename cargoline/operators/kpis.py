"""Headline KPIs: the governed summary (long) and the SQL mart summary (wide),
plus the stand-alone forecast, stockout and productivity metrics.

Every KPI is a keyless (or keyed) aggregate with partial aggregation on the
map side: one task per partition folds its rows, a single small exchange
carries the partial states.  Rates are ratios of exact integer/decimal sums
converted to DOUBLE once, so the result does not depend on partitioning.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import (
    TOTAL_MONEY,
    as_double,
    flag_int,
    flag_rate,
    ratio,
    safe_ratio,
)

# Metric names and order of the governed KPI summary.
SUMMARY_METRICS = (
    "unit_fill_rate",
    "complete_order_rate",
    "on_time_delivery_rate",
    "otif_rate",
    "backorder_rate",
    "average_lead_time_days",
    "weighted_forecast_accuracy",
    "stockout_location_sku_rate",
    "warehouse_productivity_units_per_hour",
    "average_freight_cost_per_kg",
    "total_cost_to_serve",
)


def forecast_accuracy_expr(forecast: str = "forecast_units", actual: str = "actual_units") -> list:
    """Aggregates: total forecast/actual, absolute error and weighted accuracy.

    accuracy = max(0, 1 - sum|f - a| / sum a); when sum a = 0 it is 1.0 if
    there is no error at all, else 0.0.
    """
    abs_err = F.coalesce(F.sum(F.abs(F.col(forecast) - F.col(actual))).cast(T.LongType()), F.lit(0).cast(T.LongType()))
    act = F.coalesce(F.sum(actual).cast(T.LongType()), F.lit(0).cast(T.LongType()))
    acc = (
        F.when(act == 0, F.when(abs_err == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - ratio(abs_err, act)))
    )
    return [
        F.coalesce(F.sum(forecast).cast(T.LongType()), F.lit(0).cast(T.LongType())).alias("forecast_units"),
        act.alias("actual_units"),
        abs_err.alias("absolute_error_units"),
        acc.alias("weighted_forecast_accuracy"),
    ]


def weighted_forecast_accuracy(forecasts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weighted forecast accuracy, overall or per group."""
    return forecasts.groupBy(*keys).agg(*forecast_accuracy_expr())


def stockout_rate(inventory: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of demanded location-SKUs (average daily demand > 0) with nothing on hand."""
    demanded = F.col("average_daily_demand") > 0
    n_dem = F.count_if(demanded)
    n_out = F.count_if(demanded & (F.col("on_hand_units") <= 0))
    return inventory.groupBy(*keys).agg(
        n_dem.cast(T.LongType()).alias("demanded_combinations"),
        n_out.cast(T.LongType()).alias("stockouts"),
        safe_ratio(n_out, n_dem).alias("stockout_location_sku_rate"),
    )


def warehouse_productivity(activity: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units processed per labor hour (0 when there are no hours)."""
    units = F.sum("units_processed").cast(T.LongType())
    hours = F.sum("labor_hours").cast(TOTAL_MONEY)
    return activity.groupBy(*keys).agg(
        units.alias("units_processed"),
        hours.alias("labor_hours"),
        safe_ratio(units, hours).alias("units_per_labor_hour"),
    )


def kpi_summary(service: DataFrame, forecasts: DataFrame, inventory: DataFrame, activity: DataFrame) -> DataFrame:
    """The eleven governed KPIs as a long (metric, value) table.

    ``service`` is the dataframe-policy order service (``order_service``).
    Four one-row aggregates are combined by one-row cross joins, then unpivoted.
    """
    ordered = F.sum("units_ordered")
    svc = service.agg(
        safe_ratio(F.sum("units_shipped"), ordered).alias("unit_fill_rate"),
        flag_rate("in_full").alias("complete_order_rate"),
        flag_rate("on_time").alias("on_time_delivery_rate"),
        flag_rate("otif").alias("otif_rate"),
        safe_ratio(F.sum("backorder_units"), ordered).alias("backorder_rate"),
        ratio(F.sum("lead_time_days"), F.count("lead_time_days")).alias("average_lead_time_days"),
        F.avg("freight_cost_per_kg").alias("average_freight_cost_per_kg"),
        F.coalesce(as_double(F.sum("cost_to_serve")), F.lit(0.0)).alias("total_cost_to_serve"),
    )
    fc = weighted_forecast_accuracy(forecasts).select("weighted_forecast_accuracy")
    inv = stockout_rate(inventory).select("stockout_location_sku_rate")
    act = warehouse_productivity(activity).select(
        F.col("units_per_labor_hour").alias("warehouse_productivity_units_per_hour")
    )
    wide = svc.crossJoin(F.broadcast(fc)).crossJoin(F.broadcast(inv)).crossJoin(F.broadcast(act))  # four one-row frames
    return wide.select(*[F.col(m).cast(T.DoubleType()).alias(m) for m in SUMMARY_METRICS]).unpivot(
        [], list(SUMMARY_METRICS), "metric", "value"
    )


def mart_kpi_summary(mart: DataFrame) -> DataFrame:
    """One wide row of headline KPIs over the SQL-policy mart."""
    ordered = F.sum("units_ordered")
    return mart.agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("total_orders"),
        ratio(F.sum("units_shipped"), ordered).alias("unit_fill_rate"),
        ratio(F.sum(flag_int("in_full")), F.count("in_full")).alias("complete_order_rate"),
        ratio(F.sum(flag_int("on_time")), F.count("on_time")).alias("on_time_delivery_rate"),
        ratio(F.sum(flag_int("otif")), F.count("otif")).alias("otif_rate"),
        ratio(F.sum("backorder_units"), ordered).alias("backorder_rate"),
        ratio(F.sum("lead_time_days"), F.count("lead_time_days")).alias("average_lead_time_days"),
        F.sum("cost_to_serve").cast(TOTAL_MONEY).alias("total_cost_to_serve"),
    )
