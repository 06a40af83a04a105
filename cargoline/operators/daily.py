"""Daily service mart with trailing 30-calendar-day rolling rates.

Orders are first grouped to one row per day (partial aggregation), and only
that daily table is windowed.  The RANGE frame orders by ``unix_date`` so a
gap of missing days is measured in calendar days.  Rolling rates accumulate
their natural numerators and denominators (orders for OTD/OTIF, units for
fill), never an average of daily rates.  ``lag`` gives the previous *observed*
day.  All five sums and both lags share one window ordering, hence one sort.

``partition_by`` (e.g. warehouse or carrier) runs the same mart per segment,
which also spreads the window over tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import flag_int, ratio

ROLLING_DAYS = 30

ROLLED = ("orders", "on_time_orders", "otif_orders", "units_ordered", "units_shipped")


def mart_daily_service(mart: DataFrame, partition_by: Sequence[str] = (), days: int = ROLLING_DAYS) -> DataFrame:
    keys = list(partition_by)
    on_time = F.sum(flag_int(F.coalesce(F.col("on_time"), F.lit(False))))
    otif = F.sum(flag_int(F.coalesce(F.col("otif"), F.lit(False))))
    n = F.count(F.lit(1))
    daily = mart.groupBy(*keys, "order_date").agg(
        n.cast(T.LongType()).alias("orders"),
        on_time.cast(T.LongType()).alias("on_time_orders"),
        otif.cast(T.LongType()).alias("otif_orders"),
        F.sum("units_ordered").cast(T.LongType()).alias("units_ordered"),
        F.sum("units_shipped").cast(T.LongType()).alias("units_shipped"),
        ratio(on_time, n).alias("daily_otd_rate"),
        ratio(otif, n).alias("daily_otif_rate"),
        ratio(F.sum("units_shipped"), F.sum("units_ordered")).alias("daily_fill_rate"),
    )
    day = F.unix_date("order_date")
    base = Window.partitionBy(*keys) if keys else Window.partitionBy()
    frame = base.orderBy(day.asc_nulls_last()).rangeBetween(-(days - 1), Window.currentRow)
    ordered = base.orderBy(day.asc_nulls_last())
    rolled = daily.select(
        "*", *[F.sum(c).over(frame).cast(T.LongType()).alias(f"rolling_{days}d_{c}") for c in ROLLED]
    )
    p = f"rolling_{days}d_"
    return rolled.select(
        "*",
        ratio(F.col(p + "on_time_orders"), F.col(p + "orders")).alias(p + "otd_rate"),
        ratio(F.col(p + "otif_orders"), F.col(p + "orders")).alias(p + "otif_rate"),
        ratio(F.col(p + "units_shipped"), F.col(p + "units_ordered")).alias(p + "fill_rate"),
        (F.col("daily_otd_rate") - F.lag("daily_otd_rate").over(ordered)).alias("day_over_day_otd_change"),
        (F.col("daily_otif_rate") - F.lag("daily_otif_rate").over(ordered)).alias("day_over_day_otif_change"),
    )
