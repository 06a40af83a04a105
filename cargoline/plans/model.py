"""The KPI model: every output of the library as a lazily built DataFrame.

``FulfillmentModel`` wires operators to the eight sources.  Each output is
built once per model (``functools.cached_property``), so outputs that share an
input -- five outputs read the order service -- share the same logical plan
and Spark's exchange reuse applies inside one query.  Across queries, use
``cargoline.plans.materialize.MaterializedModel``: it writes the sources and
the order-grain tables to the shared checkpoint folder and cuts the lineage.
"""
from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame

from cargoline import operators as ops
from cargoline.sources.readers import Sources


class FulfillmentModel:
    def __init__(self, sources: Sources, p90_method: str = "exact"):
        self.src = sources
        self.p90_method = p90_method

    def once(self, df: DataFrame) -> DataFrame:
        """A frame that an output reads twice; ``WrittenModel`` writes it."""
        return df

    # --- order grain ----------------------------------------------------
    @cached_property
    def order_rollup(self) -> DataFrame:
        return ops.order_rollup(self.src.erp_order_lines, "mart")

    @cached_property
    def order_service(self) -> DataFrame:
        # both marts share one aggregation of the order lines
        return ops.order_service(self.src.erp_order_lines, self.src.tms_shipments, rollup=self.order_rollup)

    @cached_property
    def mart_order_service(self) -> DataFrame:
        return ops.mart_order_service(self.src.erp_order_lines, self.src.tms_shipments, rollup=self.order_rollup)

    # --- headline KPIs ----------------------------------------------------
    @cached_property
    def kpi_summary(self) -> DataFrame:
        s = self.src
        return ops.kpi_summary(self.order_service, s.demand_forecasts, s.wms_inventory_snapshots, s.warehouse_activity)

    @cached_property
    def mart_kpi_summary(self) -> DataFrame:
        return ops.mart_kpi_summary(self.mart_order_service)

    @cached_property
    def weighted_forecast_accuracy(self) -> DataFrame:
        return ops.weighted_forecast_accuracy(self.src.demand_forecasts)

    @cached_property
    def stockout_rate(self) -> DataFrame:
        return ops.stockout_rate(self.src.wms_inventory_snapshots, ["warehouse"])

    @cached_property
    def warehouse_productivity(self) -> DataFrame:
        return ops.warehouse_productivity(self.src.warehouse_activity, ["warehouse", "activity_date"])

    # --- scorecards -------------------------------------------------------
    @cached_property
    def carrier_scorecard(self) -> DataFrame:
        return ops.carrier_scorecard(self.order_service)

    @cached_property
    def mart_carrier_scorecard(self) -> DataFrame:
        return ops.mart_carrier_scorecard(self.mart_order_service, self.p90_method)

    @cached_property
    def mart_daily_service(self) -> DataFrame:
        return ops.mart_daily_service(self.mart_order_service)

    @cached_property
    def mart_daily_service_by_warehouse(self) -> DataFrame:
        return ops.mart_daily_service(self.mart_order_service, ["warehouse"])

    @cached_property
    def customer_cost_to_serve(self) -> DataFrame:
        return ops.customer_cost_to_serve(self.order_service, self.src.customers)

    @cached_property
    def supplier_risk_scorecard(self) -> DataFrame:
        return ops.supplier_risk_scorecard(self.src.erp_order_lines, self.src.suppliers, self.order_service, self.once)

    @cached_property
    def supplier_line_shortage(self) -> DataFrame:
        return ops.supplier_line_shortage(self.src.erp_order_lines, self.src.suppliers, self.order_service)

    @cached_property
    def service_segments(self) -> DataFrame:
        return ops.service_segments(self.order_service)

    # --- inventory and planning ------------------------------------------
    @cached_property
    def stockout_exceptions(self) -> DataFrame:
        return ops.stockout_exceptions(self.src.wms_inventory_snapshots)

    @cached_property
    def days_of_inventory(self) -> DataFrame:
        return ops.days_of_inventory(self.src.wms_inventory_snapshots)

    @cached_property
    def inventory_cover(self) -> DataFrame:
        return ops.inventory_cover(self.src.wms_inventory_snapshots)

    @cached_property
    def stockout_low_cover(self) -> DataFrame:
        return ops.stockout_low_cover(self.src.wms_inventory_snapshots)

    @cached_property
    def forecast_accuracy_by_category(self) -> DataFrame:
        return ops.forecast_accuracy_by_category(self.src.demand_forecasts, self.src.products)

    @cached_property
    def demand_shock_trend(self) -> DataFrame:
        return ops.demand_shock_trend(self.src.demand_forecasts, self.src.products)

    @cached_property
    def forecast_bias_by_warehouse(self) -> DataFrame:
        return ops.demand_shock_trend(self.src.demand_forecasts, self.src.products, ["warehouse"])

    # --- data derivation (re-aimed generator rollups) ----------------------
    @cached_property
    def shipment_weight(self) -> DataFrame:
        return ops.shipment_weight(self.src.erp_order_lines)

    @cached_property
    def delivery_chronology(self) -> DataFrame:
        return ops.delivery_chronology(self.src.tms_shipments)

    @cached_property
    def demand_grid(self) -> DataFrame:
        # the adapter's sources have the lines' cells
        return ops.demand_grid(self.src.erp_order_lines, self.src.products, getattr(self.src, "demand_cells", None))

    @cached_property
    def average_daily_demand(self) -> DataFrame:
        return ops.average_daily_demand(self.src.erp_order_lines, self.src.products, getattr(self.src, "demand_cells", None))

    @cached_property
    def warehouse_activity_rollup(self) -> DataFrame:
        return ops.warehouse_activity_rollup(self.src.erp_order_lines)

    # --- dashboard views -----------------------------------------------------
    @cached_property
    def service_by_region_segment(self) -> DataFrame:
        return ops.service_by_region_segment(self.order_service, self.src.customers)

    @cached_property
    def carrier_quadrant(self) -> DataFrame:
        return ops.carrier_quadrant(self.order_service, self.carrier_scorecard)

    @cached_property
    def exception_queue(self) -> DataFrame:
        return ops.exception_queue(self.order_service)

    @cached_property
    def late_full_queue(self) -> DataFrame:
        late_only = self.order_service.filter(~self.order_service["on_time"] & self.order_service["in_full"])
        return ops.exception_queue(late_only)

    @cached_property
    def freight_per_kg_by_carrier(self) -> DataFrame:
        return ops.freight_per_kg_by_carrier(self.order_service, self.p90_method)

    @cached_property
    def lead_time_distribution(self) -> DataFrame:
        return ops.lead_time_distribution(self.order_service)

    @cached_property
    def exception_cost_pareto(self) -> DataFrame:
        return ops.exception_cost_pareto(self.order_service, "carrier")

    @cached_property
    def exception_cost_pareto_by_warehouse(self) -> DataFrame:
        return ops.exception_cost_pareto(self.order_service, "warehouse")

    @cached_property
    def carrier_stratified(self) -> DataFrame:
        return ops.carrier_stratified(self.order_service)

    @cached_property
    def critical_stockout_customers(self) -> DataFrame:
        return ops.critical_stockout_customers(
            self.src.wms_inventory_snapshots, self.src.erp_order_lines, self.src.customers, 0.9, self.p90_method
        )

    def filtered_order_service(self, filters: ops.Filters | None = None) -> DataFrame:
        """The order service under dashboard filters."""
        return self._filtered(self.order_service, filters or DEFAULT_FILTERS)

    def _filtered(self, service: DataFrame, filters: ops.Filters) -> DataFrame:
        return ops.filter_orders(service, filters, self.src.customers, self.src.erp_order_lines, self.src.products)

    def filtered(self, filters: ops.Filters) -> "FilteredModel":
        """This model with every dashboard view under ``filters``."""
        return FilteredModel(self, filters)

    @cached_property
    def filtered_service_by_region_segment(self) -> DataFrame:
        return self.filtered(CUSTOMER_FILTERS).service_by_region_segment

    @cached_property
    def filtered_exception_queue(self) -> DataFrame:
        return self.filtered(PRODUCT_FILTERS).exception_queue

    @cached_property
    def filtered_stockout_low_cover(self) -> DataFrame:
        return self.filtered(STOCKOUT_FILTERS).stockout_low_cover

    # --- governance -----------------------------------------------------------
    @cached_property
    def mart_grain_check(self) -> DataFrame:
        return ops.mart_grain_check(self.mart_order_service)

    @cached_property
    def reconcile_metrics(self) -> DataFrame:
        return ops.reconcile_metrics(
            ops.frame_metrics_long(self.kpi_summary, self.order_service),
            ops.mart_metrics_long(self.mart_kpi_summary),
        )

    @cached_property
    def reported_service(self) -> DataFrame:
        """The order service without its one-to-one guard: the report states a duplicate
        shipment as a failed check instead of raising."""
        return ops.order_service(self.src.erp_order_lines, self.src.tms_shipments, validate=False, rollup=self.order_rollup)

    @cached_property
    def reported_mart_summary(self) -> DataFrame:
        """The mart's KPIs for the report, which reads the mart this once: it is not written for them."""
        mart = self.__dict__.get("mart_order_service")
        return ops.mart_kpi_summary(FulfillmentModel.mart_order_service.func(self) if mart is None else mart)

    @cached_property
    def data_quality_report(self) -> DataFrame:
        s, service = self.src, self.reported_service
        summary = self.once(ops.kpi_summary(service, s.demand_forecasts, s.wms_inventory_snapshots, s.warehouse_activity))
        reconciled = ops.reconcile_metrics(
            ops.frame_metrics_long(summary, service), ops.mart_metrics_long(self.reported_mart_summary))
        return ops.data_quality_report(
            s.customers, s.suppliers, s.products, s.erp_order_lines, s.tms_shipments,
            s.wms_inventory_snapshots, s.demand_forecasts, s.warehouse_activity,
            summary, service, ops.carrier_scorecard(service), reconciled,
        )


VIEW_NAMES = (
    "order_service", "mart_order_service", "kpi_summary", "mart_kpi_summary", "carrier_scorecard",
    "mart_carrier_scorecard", "mart_daily_service", "customer_cost_to_serve", "stockout_exceptions",
    "supplier_risk_scorecard", "reconcile_metrics", "data_quality_report",
)


def register_views(model: FulfillmentModel, prefix: str = "") -> FulfillmentModel:
    """Expose the sources and the main outputs as temp views, so the marts can be
    queried with Spark SQL (``spark.sql("select * from mart_kpi_summary")``)."""
    model.src.register(prefix)
    for name in VIEW_NAMES:
        getattr(model, name).createOrReplaceTempView(prefix + name)
    return model


class FilteredModel(FulfillmentModel):
    """The views of a model under dashboard filters.

    Order views filter the order service: dates, warehouse and carrier by column, region
    and segment through the customer, category and supplier through the order's lines.
    Inventory and forecast views filter by date, warehouse, and category and supplier
    through the product; severity applies to the stockout views.
    """

    def __init__(self, base: FulfillmentModel, filters: ops.Filters):
        super().__init__(base.src, base.p90_method)
        self.base, self.filters = base, filters
        self.once = base.once

    @cached_property
    def order_service(self) -> DataFrame:
        return self.base._filtered(self.base.order_service, self.filters)

    @cached_property
    def mart_order_service(self) -> DataFrame:
        return self.base._filtered(self.base.mart_order_service, self.filters)

    def _stock(self, rows: DataFrame, date_column: str) -> DataFrame:
        return ops.filter_stock(rows, self.filters, self.src.products, date_column)

    @cached_property
    def stockout_exceptions(self) -> DataFrame:
        return ops.stockout_exceptions(self._stock(self.src.wms_inventory_snapshots, "snapshot_date"), severities=self.filters.severity)

    @cached_property
    def stockout_low_cover(self) -> DataFrame:
        return ops.stockout_low_cover(self._stock(self.src.wms_inventory_snapshots, "snapshot_date"), severities=self.filters.severity)

    @cached_property
    def inventory_cover(self) -> DataFrame:
        return ops.inventory_cover(self._stock(self.src.wms_inventory_snapshots, "snapshot_date"))

    @cached_property
    def forecast_accuracy_by_category(self) -> DataFrame:
        return ops.forecast_accuracy_by_category(self._stock(self.src.demand_forecasts, "month"), self.src.products)

    @cached_property
    def demand_shock_trend(self) -> DataFrame:
        return ops.demand_shock_trend(self._stock(self.src.demand_forecasts, "month"), self.src.products)

    @cached_property
    def forecast_bias_by_warehouse(self) -> DataFrame:
        return ops.demand_shock_trend(self._stock(self.src.demand_forecasts, "month"), self.src.products, ["warehouse"])


# One representative filter for each family of dimensions.
CUSTOMER_FILTERS = ops.Filters(region=("EUROPE", "ASIA"), customer_segment=("BUILDING", "MACHINERY", "AUTOMOBILE"))
PRODUCT_FILTERS = ops.Filters(product_category=("STANDARD", "PROMO", "ECONOMY"), supplier_id=(1, 2, 3, 5, 8), warehouse=("WH-CENTRAL", "WH-SOUTH"))
STOCKOUT_FILTERS = ops.Filters(severity=("Critical", "High"), product_category=("STANDARD", "PROMO"),
                               date_from=dt.date(1995, 1, 1), date_to=dt.date(1997, 12, 31))
# A representative dashboard filter: two years, two warehouses, two carriers.
DEFAULT_FILTERS = ops.Filters(
    date_from=dt.date(1996, 1, 1), date_to=dt.date(1997, 12, 31),
    warehouse=("WH-NORTH", "WH-SOUTH"), carrier=("A", "C"),
)
