"""Planning views: forecast accuracy by category and the demand-shock trend.

The forecast grid is joined to products on ``sku`` (a shuffled join whose
side AQE may turn into a broadcast at runtime), then aggregated per category
with partial aggregation.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import ratio
from cargoline.operators.kpis import forecast_accuracy_expr


def _with_category(forecasts: DataFrame, products: DataFrame) -> DataFrame:
    return forecasts.join(products.select("sku", "product_category"), "sku", "left")


def forecast_accuracy_by_category(forecasts: DataFrame, products: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weighted forecast accuracy per product category (and extra keys)."""
    return _with_category(forecasts, products).groupBy("product_category", *keys).agg(*forecast_accuracy_expr())


def demand_shock_trend(forecasts: DataFrame, products: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Month x category forecast vs actual, their ratio and the bias
    (forecast - actual) / actual; NULL when there was no actual demand."""
    f = F.sum("forecast_units").cast(T.LongType())
    a = F.sum("actual_units").cast(T.LongType())
    return _with_category(forecasts, products).groupBy("month", "product_category", *keys).agg(
        f.alias("forecast_units"),
        a.alias("actual_units"),
        ratio(f, a).alias("forecast_to_actual"),
        ratio(f - a, a).alias("forecast_bias"),
    )
