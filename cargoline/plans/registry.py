"""Query registry: name -> (spark, sf_dir) -> DataFrame over the driver's tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.plans.extracts import EXTRACT_QUERIES
from cargoline.plans.materialize import WrittenModel, WrittenTpchSources
from cargoline.plans.model import FulfillmentModel
from cargoline.session import configure
from cargoline.sources.adapter import from_tpch

SOURCE_QUERIES = (
    "customers", "suppliers", "products", "erp_order_lines", "tms_shipments",
    "wms_inventory_snapshots", "demand_forecasts", "warehouse_activity",
)

MODEL_QUERIES = (
    "order_rollup", "order_service", "mart_order_service",
    "kpi_summary", "mart_kpi_summary",
    "carrier_scorecard", "mart_carrier_scorecard", "mart_daily_service", "mart_daily_service_by_warehouse",
    "customer_cost_to_serve", "stockout_exceptions", "supplier_risk_scorecard",
    "weighted_forecast_accuracy", "stockout_rate", "warehouse_productivity", "days_of_inventory",
    "reconcile_metrics", "mart_grain_check", "data_quality_report", "service_segments",
    "shipment_weight", "delivery_chronology", "demand_grid", "average_daily_demand", "warehouse_activity_rollup",
    "service_by_region_segment", "carrier_quadrant", "exception_queue", "late_full_queue", "inventory_cover",
    "stockout_low_cover", "forecast_accuracy_by_category", "demand_shock_trend", "forecast_bias_by_warehouse",
    "freight_per_kg_by_carrier", "lead_time_distribution", "exception_cost_pareto",
    "exception_cost_pareto_by_warehouse", "filtered_order_service",
    "filtered_service_by_region_segment", "filtered_exception_queue", "filtered_stockout_low_cover", "carrier_stratified",
    "critical_stockout_customers", "supplier_line_shortage",
)


# Outputs that read a shared frame (lines, grid, order service) more than once: over the
# raw tables they run on a model that writes such a frame when it is first needed.
SEVERAL_READS = {
    "kpi_summary", "mart_carrier_scorecard", "supplier_risk_scorecard", "reconcile_metrics", "data_quality_report",
    "carrier_quadrant", "freight_per_kg_by_carrier", "critical_stockout_customers", "supplier_line_shortage",
    "filtered_exception_queue",
}

# Averages of doubles depend on the order of their sum in the last digits: the hand-over
# rounds them, the library does not.
ROUNDED = {
    "carrier_scorecard": {"average_freight_cost_per_kg": 9},
    "mart_carrier_scorecard": {"average_freight_cost_per_kg": 9, "p90_freight_cost_per_kg": 9},
    "carrier_quadrant": {"average_freight_cost_per_kg": 9, "portfolio_freight_cost_per_kg": 9},
    "freight_per_kg_by_carrier": {"average_freight_cost_per_kg": 9, "p90_freight_cost_per_kg": 9},
    "stockout_low_cover": {"average_days_of_inventory": 9, "total_average_daily_demand": 9},
    "filtered_stockout_low_cover": {"average_days_of_inventory": 9, "total_average_daily_demand": 9},
    "critical_stockout_customers": {"revenue_threshold": 6},
}


def model_for(spark: SparkSession, sf_dir: str, several_reads: bool = False, **options) -> FulfillmentModel:
    configure(spark)
    if several_reads:
        return WrittenModel(WrittenTpchSources(spark, sf_dir), **options)
    return FulfillmentModel(from_tpch(spark, sf_dir), **options)


def interchange(df: DataFrame, name: str = "") -> DataFrame:
    """The form handed to the correctness check.

    Exact money (DECIMAL) goes over as whole numbers of its smallest unit -- cents, or
    ten-thousandths for four places -- so neither engine's client can round it.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = (c * F.lit(10 ** f.dataType.scale)).cast(T.LongType())
            out.append(c.alias(f.name + {2: "_cents", 4: "_e4"}[f.dataType.scale]))
        elif name == "kpi_summary" and f.name == "value":  # one of the metrics is such an average
            out.append(F.when(F.col("metric") == "average_freight_cost_per_kg", F.round(c, 9)).otherwise(c).alias("value"))
        elif f.name in ROUNDED.get(name, {}):
            out.append(F.round(c, ROUNDED[name][f.name]).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = getattr(model_for(spark, sf_dir, name in SEVERAL_READS), name)
        return interchange(out() if callable(out) else out, name)

    run.__name__ = name
    return run


def _source_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return interchange(getattr(from_tpch(spark, sf_dir), name), name)

    run.__name__ = name
    return run


def _extract_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return interchange(EXTRACT_QUERIES[name](spark, sf_dir), name.removeprefix("csv_"))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _source_query(name) for name in SOURCE_QUERIES}
    out.update({name: _model_query(name) for name in MODEL_QUERIES})
    out.update({name: _extract_query(name) for name in EXTRACT_QUERIES})
    return out
