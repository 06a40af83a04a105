"""Materialise the sources and the order grain as parquet tables.

Five outputs read the order service and every output reads the sources, so a
full refresh writes those once and runs every KPI over the written tables:
lineage is cut (a lost executor recomputes from the written files, not from
the raw extracts) and nothing is recomputed per output.  Tables go to a fresh
folder under the session's ``spark.checkpoint.dir`` -- the shared folder a
cluster names there; only local runs get a scratch folder (see
``cargoline.session.checkpoint_dir``).  ``localCheckpoint`` is never used.
"""
from __future__ import annotations

import os

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cargoline.plans.model import DEFAULT_FILTERS, FulfillmentModel
from cargoline.session import new_folder, written_once
from cargoline.sources.adapter import TpchSources
from cargoline.sources.readers import Sources, by_month, write_parquet_sources


def materialize_sources(spark: SparkSession, sources: Sources, folder: str | None = None) -> Sources:
    """Write the sources under ``folder`` and return them reading the written files."""
    folder = folder or new_folder(spark, "sources")
    return write_parquet_sources(sources, folder, keep_projections=True)


class MaterializedModel(FulfillmentModel):
    """A model whose sources and order-grain marts were written to parquet."""

    def __init__(self, spark: SparkSession, sources: Sources, folder: str | None = None, **options):
        folder = folder or new_folder(spark, "model")
        self._by_month = {}
        written = materialize_sources(spark, sources, os.path.join(folder, "sources"))
        super().__init__(written, **options)
        base = FulfillmentModel(written, **options)
        # the order rollup is written once; both order-grain marts read it
        roll_path = os.path.join(folder, "order_rollup")
        base.order_rollup.write.mode("overwrite").parquet(roll_path)
        base.__dict__["order_rollup"] = self.__dict__["order_rollup"] = spark.read.parquet(roll_path)
        for name in ("order_service", "mart_order_service"):
            path = os.path.join(folder, name)
            # partitioned by order month: date filters on any mart prune files
            by_month(getattr(base, name)).write.mode("overwrite").partitionBy("order_month").parquet(path)
            self._by_month[name] = spark.read.parquet(path)
            self.__dict__[name] = self._by_month[name].drop("order_month")  # fills the cached_property
        self.folder = folder

    def filtered_order_service(self, filters=None):
        """O35 over the month-partitioned table: date filters prune partitions."""
        return self._filtered(self._by_month["order_service"], filters or DEFAULT_FILTERS).drop("order_month")


class WrittenTpchSources(TpchSources):
    """The adapter's sources; order lines, shipments and the grid are written on first use, too."""

    @cached_property
    def erp_order_lines(self) -> DataFrame:
        return written_once(TpchSources.erp_order_lines.func(self), "lines")

    @cached_property
    def tms_shipments(self) -> DataFrame:
        return written_once(TpchSources.tms_shipments.func(self), "shipments")

    @cached_property
    def demand_grid(self) -> DataFrame:
        return written_once(TpchSources.demand_grid.func(self), "grid")


class WrittenModel(FulfillmentModel):
    """A model for outputs that read a frame several times: what an output shares is written
    when it is first needed, so nothing upstream of it runs twice."""

    def once(self, df: DataFrame) -> DataFrame:
        return written_once(df)

    @cached_property
    def order_rollup(self) -> DataFrame:
        return self.once(FulfillmentModel.order_rollup.func(self))

    @cached_property
    def order_service(self) -> DataFrame:
        return self.once(FulfillmentModel.order_service.func(self))

    @cached_property
    def reported_service(self) -> DataFrame:
        return self.once(FulfillmentModel.reported_service.func(self))

    @cached_property
    def mart_order_service(self) -> DataFrame:
        return self.once(FulfillmentModel.mart_order_service.func(self))
