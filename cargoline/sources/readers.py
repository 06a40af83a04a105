"""Readers and writers for the eight fulfillment source tables."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File name of each source table in an extract folder.
SOURCE_FILES = {
    "customers": "customers",
    "suppliers": "suppliers",
    "products": "products",
    "erp_order_lines": "erp_order_lines",
    "tms_shipments": "tms_shipments",
    "wms_inventory_snapshots": "wms_inventory_snapshots",
    "demand_forecasts": "demand_forecasts",
    "warehouse_activity": "warehouse_activity",
}


class Sources:
    """The eight source tables as lazy DataFrames (attributes named like the tables)."""

    def __init__(self, **tables: DataFrame):
        missing = set(SOURCE_FILES) - set(tables)
        if missing:
            raise ValueError(f"missing source tables: {sorted(missing)}")
        for name in SOURCE_FILES:
            setattr(self, name, tables[name])

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SOURCE_FILES}

    def register(self, prefix: str = "") -> "Sources":
        """Expose every table as a temp view (``prefix + name``) for Spark SQL."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)
        return self

    def rebase(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. the written copy) for table ``name``."""
        setattr(self, name, df)

    def intermediates(self) -> list[str]:
        """Derived tables several sources share (written once when materialising)."""
        return []

    def projections(self) -> list[str]:
        """Source tables that are cheap projections of a written intermediate
        (left as projections when materialising instead of written again)."""
        return []

    def replace(self, **tables: DataFrame) -> "Sources":
        data = self.as_dict()
        data.update(tables)
        return Sources(**data)


def read_parquet_sources(spark: SparkSession, folder: str) -> Sources:
    """Parquet source tables (one folder or file per table)."""
    tables = {name: spark.read.parquet(os.path.join(folder, stem)) for name, stem in SOURCE_FILES.items()}
    if "order_month" in tables["erp_order_lines"].columns:  # partition column of our writer
        tables["erp_order_lines"] = tables["erp_order_lines"].drop("order_month")
    return Sources(**tables)


def by_month(df: DataFrame) -> DataFrame:
    """``df`` with its ``order_month``, rebalanced by it before a partitioned write.

    Rows of a month meet in one task, and adaptive execution splits a large month and
    joins small ones to the advisory partition size, so the number of files follows the
    bytes written, not writers x months.
    """
    return df.withColumn("order_month", F.trunc("order_date", "month")).hint("rebalance", "order_month")


def write_parquet_sources(sources: Sources, folder: str, mode: str = "overwrite",
                          keep_projections: bool = False) -> Sources:
    """Write the tables as parquet and point ``sources`` at the written copies.

    Order lines are written first (partitioned by order month, so date filters
    prune files); tables derived from them are then built from the written
    copy, so nothing upstream of the lines is computed twice.  Shared
    intermediates (e.g. the demand grid) are written once.  With
    ``keep_projections`` (materialisation) tables that are mere projections of
    an intermediate stay projections over its written files; by default every
    table is written, so the folder is a complete, re-readable extract.
    """
    spark = sources.erp_order_lines.sparkSession
    order = ["erp_order_lines"] + [n for n in SOURCE_FILES if n != "erp_order_lines"]
    skip = set(sources.projections()) if keep_projections else set()
    for name in order:
        if name in skip:
            continue
        df = getattr(sources, name)
        path = os.path.join(folder, SOURCE_FILES[name])
        if name == "erp_order_lines":
            by_month(df).write.mode(mode).partitionBy("order_month").parquet(path)
            sources.rebase(name, spark.read.parquet(path).drop("order_month"))
            for shared in sources.intermediates():  # e.g. the demand grid, from the written lines
                shared_path = os.path.join(folder, "_" + shared)
                getattr(sources, shared).write.mode(mode).parquet(shared_path)
                sources.rebase(shared, spark.read.parquet(shared_path))
        else:
            df.write.mode(mode).parquet(path)
            sources.rebase(name, spark.read.parquet(path))
    return sources
