"""DataFrame-in, DataFrame-out KPI operators."""
from cargoline.operators.daily import mart_daily_service  # noqa: F401
from cargoline.operators.demand import average_daily_demand, demand_cells, demand_grid, monthly_demand_grid  # noqa: F401
from cargoline.operators.inventory import (  # noqa: F401
    days_of_inventory,
    inventory_cover,
    stockout_exceptions,
    stockout_low_cover,
    warehouse_activity_rollup,
)
from cargoline.operators.kpis import (  # noqa: F401
    SUMMARY_METRICS,
    kpi_summary,
    mart_kpi_summary,
    stockout_rate,
    warehouse_productivity,
    weighted_forecast_accuracy,
)
from cargoline.operators.planning import demand_shock_trend, forecast_accuracy_by_category  # noqa: F401
from cargoline.operators.quality import data_quality_report, mart_grain_check  # noqa: F401
from cargoline.operators.quantiles import percentile_cont  # noqa: F401
from cargoline.operators.reconcile import (  # noqa: F401
    RECONCILED_METRICS,
    frame_metrics_long,
    mart_metrics_long,
    reconcile_metrics,
)
from cargoline.operators.scorecards import (  # noqa: F401
    carrier_scorecard,
    customer_cost_to_serve,
    mart_carrier_scorecard,
    supplier_line_shortage,
    supplier_risk_scorecard,
)
from cargoline.operators.service import (  # noqa: F401
    delivery_chronology,
    frame_rollup,
    mart_order_service,
    order_rollup,
    order_service,
    service_segments,
    shipment_weight,
)
from cargoline.operators.views import (  # noqa: F401
    Filters,
    apply_filters,
    carrier_quadrant,
    carrier_stratified,
    critical_stockout_customers,
    exception_cost_pareto,
    exception_queue,
    filter_orders,
    filter_stock,
    freight_per_kg_by_carrier,
    lead_time_distribution,
    service_by_region_segment,
)
