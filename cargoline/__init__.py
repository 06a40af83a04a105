"""cargoline: fulfillment and inventory KPIs as Spark DataFrame jobs."""

__version__ = "0.1.0"
