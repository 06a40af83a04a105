"""Monthly demand (O22, O23): sparse cells from the order lines, and the dense grid made of them.

The lines are read once, for the cells.  Everything else comes from the cells, which are as
many as (SKU, warehouse, month) combinations that were ordered: callers that build more than
one frame from them hand in a written table.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.session import written_once

#: rows of the dense grid a task writes out (some 10 MB of parquet)
GRID_ROWS = 2_000_000
#: ... and down to this number, to give every core a task
GRID_ROWS_LEAST = 100_000


def demand_cells(lines: DataFrame) -> DataFrame:
    """Units ordered by SKU, warehouse and month number (year * 12 + month - 1).

    A line without SKU, warehouse or date has no cell.
    """
    known = F.col("sku").isNotNull() & F.col("warehouse").isNotNull() & F.col("order_date").isNotNull()
    month = F.year("order_date") * 12 + F.month("order_date") - 1
    return lines.filter(known).groupBy("sku", "warehouse", month.alias("month_number")).agg(
        F.sum("units_ordered").cast(T.LongType()).alias("demand"))


def grid_partitions(rows: int, cores: int) -> int:
    """Partitions of a dense grid of ``rows``: by what they write, and no fewer than keep the cores busy."""
    return max(1, math.ceil(rows / GRID_ROWS), min(cores, math.ceil(rows / GRID_ROWS_LEAST)))


def monthly_demand_grid(cells: DataFrame, products: DataFrame) -> DataFrame:
    """Dense month x warehouse x SKU grid with demand (0 where nothing was ordered),
    ``days_in_month`` and the SKU's ``unit_price``.

    Months are the calendar span of the cells, warehouses those that occur in them.  Both
    and the number of products are read first (three numbers and a list of warehouses),
    so the number of rows is known before they exist: products and the cells, folded to
    one sorted list per SKU and warehouse, are dealt by that key to as many partitions as
    the grid's rows need.  Each task then writes out every entry and the empty months after it,
    in one pass over the list.  The dense rows are never shuffled.
    """
    spark = cells.sparkSession
    span = cells.agg(F.min("month_number").alias("first"), F.max("month_number").alias("last"),
                     F.sort_array(F.collect_set("warehouse")).alias("warehouses")).first()
    n = grid_partitions(products.count() * len(span.warehouses) * ((span.last or 0) - (span.first or 0) + 1), spark.sparkContext.defaultParallelism)
    zero = F.lit(0).cast(T.LongType())
    first, last = F.lit(span.first).cast("int"), F.lit(span.last).cast("int")
    folded = cells.repartition(n, "sku", "warehouse").groupBy("sku", "warehouse").agg(
        F.sort_array(F.collect_list(F.struct(F.col("month_number").alias("m"), F.col("demand").alias("d")))).alias("cells"))
    warehouses = F.array(*[F.lit(w) for w in span.warehouses]).cast("array<string>")
    listed = products.select("sku", "unit_price", F.explode(warehouses).alias("warehouse")).repartition(n, "sku", "warehouse")
    start = F.array(F.struct(first.alias("m"), zero.alias("d")))
    entries = F.when(F.col("cells").isNull(), start).when(F.col("cells")[0]["m"] > first, F.concat(start, "cells")).otherwise(F.col("cells"))
    # each entry stands for its month and the empty months up to the next entry
    runs = (
        listed.join(folded, ["sku", "warehouse"], "left").withColumn("runs", entries)
        .select("sku", "unit_price", "warehouse", F.inline(F.transform("runs", lambda e, i: F.struct(
            e["m"].alias("m"), F.coalesce(e["d"], zero).alias("d"),
            F.coalesce(F.get("runs", i + 1)["m"], last + 1).alias("next")))))
    )
    return (
        runs.select("sku", "unit_price", "warehouse", "d", F.posexplode(F.sequence("m", F.col("next") - 1)).alias("i", "m"))
        .withColumn("demand", F.when(F.col("i") == 0, F.col("d")).otherwise(zero))
        .withColumn("month", F.make_date(F.expr("m div 12").cast("int"), (F.col("m") % 12 + 1).cast("int"), F.lit(1)))
        .select("month", "warehouse", "sku", "unit_price", "demand", F.dayofmonth(F.last_day("month")).alias("days_in_month"))
    )


def _grid_of(lines: DataFrame, products: DataFrame, cells: DataFrame | None) -> DataFrame:
    return monthly_demand_grid(written_once(demand_cells(lines), "demand-cells") if cells is None else cells, products)


def demand_grid(lines: DataFrame, products: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Dense month x warehouse x sku demand, 0 where nothing was ordered (``cells``: the lines' cells, written)."""
    return _grid_of(lines, products, cells).select(
        "month", "warehouse", "sku", F.col("demand").cast(T.LongType()).alias("demand_units"))


def average_daily_demand(lines: DataFrame, products: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Month demand / days in month over the dense grid."""
    return _grid_of(lines, products, cells).select(
        "month", "warehouse", "sku",
        F.col("demand").cast(T.LongType()).alias("demand_units"),
        F.col("days_in_month").cast(T.LongType()).alias("days_in_month"),
        (F.col("demand") / F.col("days_in_month")).alias("average_daily_demand"),
    )
