"""Reconcile the dataframe-path KPIs with the SQL-mart KPIs.

Both sides are long (metric, value) frames of at most a dozen rows; the
comparison is a join on metric against the governed metric list, so a metric
missing on either side is a FAIL row instead of an exception.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import isclose

# Reconciled metrics, rounding decimals and default tolerance.
RECONCILED_METRICS = (
    "total_orders",
    "unit_fill_rate",
    "complete_order_rate",
    "on_time_delivery_rate",
    "otif_rate",
    "backorder_rate",
    "average_lead_time_days",
    "total_cost_to_serve",
)
METRIC_DECIMALS = {"total_orders": 0, "total_cost_to_serve": 2}
DEFAULT_DECIMALS = 12
DEFAULT_TOLERANCE = 1e-9


def _round_half_even(x: F.Column, metric: F.Column) -> F.Column:
    # bround takes a literal scale: pick the branch per metric
    out = F.bround(x, DEFAULT_DECIMALS)
    for name, d in METRIC_DECIMALS.items():
        out = F.when(metric == name, F.bround(x, d)).otherwise(out)
    return out


def mart_metrics_long(mart_summary: DataFrame) -> DataFrame:
    """The wide mart summary (O5) as (metric, value DOUBLE)."""
    cols = [c for c in mart_summary.columns]
    return mart_summary.select(*[F.col(c).cast(T.DoubleType()).alias(c) for c in cols]).unpivot(
        [], cols, "metric", "value"
    )


def frame_metrics_long(summary: DataFrame, service: DataFrame) -> DataFrame:
    """The dataframe-path summary (O4) plus ``total_orders`` = rows of O2."""
    orders = service.agg(F.count(F.lit(1)).cast(T.DoubleType()).alias("value")).select(
        F.lit("total_orders").alias("metric"), "value"
    )
    return summary.select("metric", F.col("value").cast(T.DoubleType())).unionByName(orders)


def reconcile_metrics(python_values: DataFrame, sql_values: DataFrame, tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """metric, python_value, sql_value, absolute_difference, tolerance, status.

    Values are rounded half-even (0 dp for counts, 2 for money, 12 otherwise)
    before an ``isclose`` test with relative and absolute tolerance.
    """
    spark = python_values.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(m) for m in RECONCILED_METRICS])).alias("metric"))
    py = python_values.select("metric", F.col("value").alias("_py"))
    sq = sql_values.select("metric", F.col("value").alias("_sql"))
    joined = wanted.join(py, "metric", "left").join(sq, "metric", "left")
    m = F.col("metric")
    pv = _round_half_even(F.col("_py"), m)
    sv = _round_half_even(F.col("_sql"), m)
    return joined.select(
        "metric",
        pv.alias("python_value"),
        sv.alias("sql_value"),
        F.bround(F.abs(pv - sv), DEFAULT_DECIMALS).alias("absolute_difference"),
        F.lit(float(tolerance)).alias("tolerance"),
        F.when(isclose(pv, sv, tolerance, tolerance), "PASS").otherwise("FAIL").alias("status"),
    )
