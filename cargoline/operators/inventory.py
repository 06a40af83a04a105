"""Inventory cover, stockout exceptions and the demand rollups behind them.

All steps are row projections, filters (pushed into the scan) or grouped
aggregates; the latest snapshot per location-SKU uses ``max_by`` inside a
partial aggregate instead of a row_number window over all snapshots.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import (
    EXCEPTION_COVER_DAYS,
    severity,
    severity_rank,
)


def days_of_inventory(inventory: DataFrame) -> DataFrame:
    """On hand / average daily demand per snapshot row; NULL at zero demand."""
    add = F.col("average_daily_demand")
    return inventory.withColumn(
        "days_of_inventory", F.when(add > 0, F.col("on_hand_units").cast("double") / add)
    )


def stockout_exceptions(inventory: DataFrame, ordered: bool = False, severities: Sequence[str] | None = None) -> DataFrame:
    """Demanded rows with at most five days of cover, banded by severity.

    The list's order is severity (``severity_rank``) then demand desc.  With
    ``ordered=True`` the frame is globally sorted that way; it is off by
    default because a global sort of a scan-fed output costs a sampling pass
    over the whole input plus a range shuffle -- consumers sort when writing
    or take a top-k.  ``severities`` keeps some of the bands (O35).
    """
    add = F.col("average_daily_demand")
    rows = inventory.filter((add > 0) & (F.col("on_hand_units") <= add * EXCEPTION_COVER_DAYS))
    out = (
        days_of_inventory(rows)
        .withColumn("severity", severity("days_of_inventory"))
        .withColumn("severity_rank", severity_rank("severity"))
    )
    if severities is not None:
        out = out.filter(F.col("severity").isin(list(severities)))
    if ordered:
        out = out.orderBy(F.col("severity_rank").asc_nulls_last(), add.desc(), "snapshot_date", "warehouse", "sku")
    return out


def warehouse_activity_rollup(lines: DataFrame) -> DataFrame:
    """Units shipped (processed) per month and warehouse."""
    return lines.groupBy(F.trunc("order_date", "month").alias("activity_month"), "warehouse").agg(
        F.sum("units_shipped").cast(T.LongType()).alias("units_processed"),
        F.count(F.lit(1)).cast(T.LongType()).alias("order_lines"),
    )


def inventory_cover(inventory: DataFrame) -> DataFrame:
    """Days of inventory per warehouse and SKU at its latest snapshot."""
    latest = inventory.groupBy("warehouse", "sku").agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.max_by("on_hand_units", "snapshot_date").alias("on_hand_units"),
        F.max_by("average_daily_demand", "snapshot_date").alias("average_daily_demand"),
    )
    return days_of_inventory(latest)


def stockout_low_cover(inventory: DataFrame, severities: Sequence[str] | None = None) -> DataFrame:
    """Stockout / low-cover exceptions counted by warehouse and severity."""
    exc = stockout_exceptions(inventory, severities=severities)
    return exc.groupBy("warehouse", "severity", "severity_rank").agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("exceptions"),
        F.sum("on_hand_units").cast(T.LongType()).alias("on_hand_units"),
        F.avg("days_of_inventory").alias("average_days_of_inventory"),
        F.sum("average_daily_demand").alias("total_average_daily_demand"),
    )

