"""Independent SQL definitions (DuckDB dialect) of every registered query.

Each string runs on DuckDB over views named after the driver's tables
(``lineitem orders part supplier customer nation region``).  The adapter is
re-stated as SQL CTEs and every KPI is written from its definition, not from
our DataFrame code, so the comparison checks the Spark plans independently.

Conventions that make both engines agree bit for bit: rates divide two
DOUBLEs cast from exact integer/decimal sums; averages of doubles are rounded
to 9 places; constants that enter double arithmetic are DOUBLE literals;
every output column is cast to an explicit type.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# Adapter: driver tables -> the eight fulfillment sources
# ---------------------------------------------------------------------------
ADAPTER = {
    "hdr": """
    SELECT o_orderkey, o_custkey,
           CASE o_orderkey % 3 WHEN 0 THEN 'WH-NORTH' WHEN 1 THEN 'WH-CENTRAL' ELSE 'WH-SOUTH' END AS warehouse,
           CAST(o_orderdate AS DATE) AS order_date,
           CAST(o_orderdate AS DATE) + CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 3
                                                            WHEN '5-LOW' THEN 7 ELSE 5 END AS promised_date
    FROM orders""",
    "lines_sz": """
    SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_line_id,
           l.l_orderkey AS order_id, h.o_custkey AS customer_id, h.warehouse, h.order_date, h.promised_date,
           l.l_partkey AS sku, l.l_suppkey AS supplier_id,
           CAST(l.l_quantity AS BIGINT) AS units_ordered,
           CASE WHEN (7 * l.l_partkey + 3 * l.l_suppkey + l.l_linenumber) % 31 = 0
                THEN (CAST(l.l_quantity AS BIGINT) * (l.l_partkey % 4)) // 4
                ELSE CAST(l.l_quantity AS BIGINT) END AS units_shipped,
           CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price,
           CAST(CAST(p.p_size * 25 AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS unit_weight_kg,
           p.p_size
    FROM lineitem l JOIN hdr h ON l.l_orderkey = h.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "erp_order_lines": """
    SELECT order_line_id, order_id, customer_id, warehouse, order_date, promised_date, sku, supplier_id,
           CAST(units_ordered AS BIGINT) AS units_ordered, CAST(units_shipped AS BIGINT) AS units_shipped,
           unit_price, unit_weight_kg, CAST(units_shipped * unit_price AS DECIMAL(18,2)) AS revenue
    FROM lines_sz""",
    "ship_base": """
    SELECT h.*, COALESCE(w.wq, 0) AS wq,
           h.order_date + CAST(h.o_custkey % 4 AS INTEGER) AS ship_date,
           CASE WHEN (13 * h.o_orderkey + 7 * h.o_custkey) % 25 = 0 THEN -1
                WHEN (13 * h.o_orderkey + 7 * h.o_custkey) % 25 <= 17 THEN 0
                WHEN (13 * h.o_orderkey + 7 * h.o_custkey) % 25 <= 20 THEN 1
                WHEN (13 * h.o_orderkey + 7 * h.o_custkey) % 25 <= 22 THEN 2
                WHEN (13 * h.o_orderkey + 7 * h.o_custkey) % 25 = 23 THEN 3 ELSE 5 END AS delay
    FROM hdr h
    LEFT JOIN (SELECT order_id, SUM(units_shipped * p_size) AS wq FROM lines_sz GROUP BY order_id) w
           ON w.order_id = h.o_orderkey
    WHERE h.o_orderkey % 40 <> 7""",
    "ship_dated": """
    SELECT *, greatest(promised_date + delay, ship_date) AS delivery_date FROM ship_base""",
    "tms_shipments": """
    SELECT o_orderkey AS shipment_id, o_orderkey AS order_id,
           substr('AAABBBCCDD', CAST(o_orderkey % 10 + 1 AS INTEGER), 1) AS carrier,
           warehouse, ship_date, delivery_date, promised_date,
           CAST(CAST(wq * 25 AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS shipment_weight_kg,
           CAST(CAST(2400 + wq * (9 + o_orderkey % 13) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS freight_cost,
           CAST(CAST(400 + o_custkey % 1400 AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS handling_cost,
           CAST(CAST(CASE WHEN delivery_date > promised_date THEN 500 + o_orderkey % 5500 ELSE 0 END
                     AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS exception_cost,
           delivery_date <= promised_date AS on_time
    FROM ship_dated""",
    "customers": """
    SELECT c.c_custkey AS customer_id, c.c_mktsegment AS customer_segment, r.r_name AS region
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "suppliers": """
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
           CAST(5 + s_suppkey % 17 AS INTEGER) AS base_lead_time_days,
           CASE WHEN s_suppkey % 20 < 11 THEN 'Low' WHEN s_suppkey % 20 < 17 THEN 'Medium' ELSE 'High' END
             AS supplier_risk_tier
    FROM supplier""",
    "products": """
    SELECT p_partkey AS sku, p_type AS product_category,
           p_partkey % (SELECT count(*) FROM supplier) AS supplier_id,
           CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
           CAST(CAST(p_size * 25 AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS unit_weight_kg
    FROM part""",
    "months": """
    SELECT CAST(unnest(generate_series(
               CAST(date_trunc('month', min(order_date)) AS TIMESTAMP),
               CAST(date_trunc('month', max(order_date)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
    FROM erp_order_lines""",
    "whs": """
    SELECT * FROM (VALUES ('WH-NORTH'), ('WH-CENTRAL'), ('WH-SOUTH')) t(warehouse)""",
    "grid": """
    SELECT m.month, w.warehouse, p.sku, COALESCE(d.demand, 0) AS demand,
           dayofmonth(last_day(m.month)) AS days_in_month
    FROM months m CROSS JOIN whs w CROSS JOIN products p
    LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, warehouse, sku,
                      SUM(units_ordered) AS demand
               FROM erp_order_lines GROUP BY 1, 2, 3) d
           ON d.month = m.month AND d.warehouse = w.warehouse AND d.sku = p.sku""",
    "wms_inventory_snapshots": """
    SELECT snapshot_date, warehouse, sku, CAST(on_hand_units AS BIGINT) AS on_hand_units, average_daily_demand,
           CAST(CAST(on_hand_units * price_cents * 55 AS DECIMAL(30,0)) * 0.0001 AS DECIMAL(18,4)) AS inventory_value
    FROM (SELECT g.month AS snapshot_date, g.warehouse, g.sku,
                 greatest(0, (g.demand * (5 + (7 * g.sku + month(g.month)) % 20)) // g.days_in_month
                             + (g.sku + 11 * month(g.month)) % 17 - 8) AS on_hand_units,
                 g.demand / g.days_in_month AS average_daily_demand,
                 CAST(p.unit_price * 100 AS BIGINT) AS price_cents
          FROM grid g LEFT JOIN products p ON p.sku = g.sku)""",
    "demand_forecasts": """
    SELECT month, warehouse, sku,
           CAST((demand * ((31 * sku + 17 * month(month)) % 37 + 82)
                 * CASE WHEN month(month) IN (9, 10) AND sku % 10 IN (7, 8, 9) THEN 18 ELSE 10 END) // 1000
                AS BIGINT) AS forecast_units,
           CAST(demand AS BIGINT) AS actual_units
    FROM grid""",
    "warehouse_activity": """
    SELECT c.month AS activity_date, c.warehouse,
           CAST(COALESCE(s.units, 0) AS BIGINT) AS units_processed,
           CAST(greatest(80, COALESCE(s.units, 0) // (18 + month(c.month))) AS DECIMAL(18,2)) AS labor_hours
    FROM (SELECT month, warehouse FROM months CROSS JOIN whs) c
    LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, warehouse,
                      SUM(units_shipped) AS units
               FROM erp_order_lines GROUP BY 1, 2) s
           ON s.month = c.month AND s.warehouse = c.warehouse""",
}

# ---------------------------------------------------------------------------
# Order grain under both null policies
# ---------------------------------------------------------------------------
ORDER_GRAIN = {
    "roll_m": """
    SELECT order_id, min(customer_id) AS customer_id, min(warehouse) AS warehouse,
           min(order_date) AS order_date, max(promised_date) AS promised_date,
           CAST(sum(units_ordered) AS BIGINT) AS units_ordered, CAST(sum(units_shipped) AS BIGINT) AS units_shipped,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue
    FROM erp_order_lines GROUP BY order_id""",
    "mart": """
    SELECT r.*, s.carrier, s.delivery_date, s.freight_cost, s.handling_cost, s.exception_cost, s.shipment_weight_kg,
           r.units_shipped >= r.units_ordered AS in_full,
           s.delivery_date <= r.promised_date AS on_time,
           (r.units_shipped >= r.units_ordered) AND (s.delivery_date <= r.promised_date) AS otif,
           CAST(date_diff('day', r.order_date, s.delivery_date) AS BIGINT) AS lead_time_days,
           CAST(greatest(r.units_ordered - r.units_shipped, 0) AS BIGINT) AS backorder_units,
           CAST(s.freight_cost + s.handling_cost + s.exception_cost AS DECIMAL(18,2)) AS cost_to_serve,
           CAST(s.freight_cost AS DOUBLE) / CAST(nullif(s.shipment_weight_kg, 0) AS DOUBLE) AS freight_cost_per_kg
    FROM roll_m r LEFT JOIN tms_shipments s ON s.order_id = r.order_id""",
    "roll_f": """
    SELECT order_id, min(customer_id) AS customer_id, min(warehouse) AS warehouse,
           min(order_date) AS order_date, max(promised_date) AS promised_date,
           CAST(coalesce(sum(units_ordered), 0) AS BIGINT) AS units_ordered,
           CAST(coalesce(sum(units_shipped), 0) AS BIGINT) AS units_shipped,
           CAST(coalesce(sum(revenue), 0) AS DECIMAL(38,2)) AS revenue
    FROM erp_order_lines WHERE order_id IS NOT NULL GROUP BY order_id""",
    "svc": """
    SELECT r.order_id, r.customer_id, r.warehouse, r.order_date, r.promised_date, s.delivery_date,
           r.units_ordered, r.units_shipped, r.revenue, s.freight_cost, s.handling_cost, s.exception_cost,
           CAST(coalesce(s.freight_cost, 0) + coalesce(s.handling_cost, 0) + coalesce(s.exception_cost, 0)
                AS DECIMAL(18,2)) AS cost_to_serve,
           s.shipment_weight_kg, s.carrier,
           r.units_shipped >= r.units_ordered AS in_full,
           coalesce(s.delivery_date <= r.promised_date, false) AS on_time,
           (r.units_shipped >= r.units_ordered) AND coalesce(s.delivery_date <= r.promised_date, false) AS otif,
           CAST(date_diff('day', r.order_date, s.delivery_date) AS BIGINT) AS lead_time_days,
           CAST(greatest(r.units_ordered - r.units_shipped, 0) AS BIGINT) AS backorder_units,
           CASE WHEN s.shipment_weight_kg > 0
                THEN CAST(s.freight_cost AS DOUBLE) / CAST(s.shipment_weight_kg AS DOUBLE) END AS freight_cost_per_kg
    FROM roll_f r LEFT JOIN tms_shipments s ON s.order_id = r.order_id""",
}


def _rate(num: str, den: str) -> str:
    """DOUBLE ratio, NULL on a zero denominator."""
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0))"


def _flag_rate(c: str) -> str:
    return _rate(f"sum(CAST({c} AS INTEGER))", f"count({c})")


# ---------------------------------------------------------------------------
# KPI building blocks (shared CTEs)
# ---------------------------------------------------------------------------
KPI = {
    "fc_total": f"""
    SELECT CAST(coalesce(sum(forecast_units), 0) AS BIGINT) AS forecast_units,
           CAST(coalesce(sum(actual_units), 0) AS BIGINT) AS actual_units,
           CAST(coalesce(sum(abs(forecast_units - actual_units)), 0) AS BIGINT) AS absolute_error_units
    FROM demand_forecasts""",
    "fc_acc": f"""
    SELECT *, CASE WHEN actual_units = 0 THEN CASE WHEN absolute_error_units = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                   ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - {_rate('absolute_error_units', 'actual_units')}) END
                AS weighted_forecast_accuracy
    FROM fc_total""",
    "inv_rate": f"""
    SELECT coalesce({_rate("count(*) FILTER (WHERE average_daily_demand > 0 AND on_hand_units <= 0)",
                           "count(*) FILTER (WHERE average_daily_demand > 0)")}, 0.0::DOUBLE)
             AS stockout_location_sku_rate
    FROM wms_inventory_snapshots""",
    "prod_rate": f"""
    SELECT coalesce({_rate('sum(units_processed)', 'sum(labor_hours)')}, 0.0::DOUBLE)
             AS warehouse_productivity_units_per_hour
    FROM warehouse_activity""",
    "svc_kpi": f"""
    SELECT coalesce({_rate('sum(units_shipped)', 'sum(units_ordered)')}, 0.0::DOUBLE) AS unit_fill_rate,
           {_flag_rate('in_full')} AS complete_order_rate,
           {_flag_rate('on_time')} AS on_time_delivery_rate,
           {_flag_rate('otif')} AS otif_rate,
           coalesce({_rate('sum(backorder_units)', 'sum(units_ordered)')}, 0.0::DOUBLE) AS backorder_rate,
           {_rate('sum(lead_time_days)', 'count(lead_time_days)')} AS average_lead_time_days,
           round(avg(freight_cost_per_kg), 9) AS average_freight_cost_per_kg,
           coalesce(CAST(sum(cost_to_serve) AS DOUBLE), 0.0::DOUBLE) AS total_cost_to_serve,
           CAST(count(*) AS DOUBLE) AS total_orders
    FROM svc""",
    "kpi_wide": """
    SELECT * FROM svc_kpi CROSS JOIN fc_acc CROSS JOIN inv_rate CROSS JOIN prod_rate""",
    "mart_kpi": f"""
    SELECT CAST(count(*) AS BIGINT) AS total_orders,
           {_rate('sum(units_shipped)', 'sum(units_ordered)')} AS unit_fill_rate,
           {_flag_rate('in_full')} AS complete_order_rate,
           {_flag_rate('on_time')} AS on_time_delivery_rate,
           {_flag_rate('otif')} AS otif_rate,
           {_rate('sum(backorder_units)', 'sum(units_ordered)')} AS backorder_rate,
           {_rate('sum(lead_time_days)', 'count(lead_time_days)')} AS average_lead_time_days,
           CAST(sum(cost_to_serve) AS DECIMAL(38,2)) AS total_cost_to_serve
    FROM mart""",
    "carriers": f"""
    SELECT carrier, CAST(count(order_id) AS BIGINT) AS orders,
           {_flag_rate('otif')} AS otif_rate,
           {_flag_rate('on_time')} AS on_time_delivery_rate,
           {_rate('sum(lead_time_days)', 'count(lead_time_days)')} AS average_lead_time_days,
           {_rate('sum(freight_cost)', 'count(freight_cost)')} AS average_freight_cost,
           round(avg(freight_cost_per_kg), 9) AS average_freight_cost_per_kg,
           CAST(sum(exception_cost) AS DECIMAL(38,2)) AS total_exception_cost
    FROM svc WHERE carrier IS NOT NULL GROUP BY carrier""",
    "stockouts": """
    SELECT *, CAST(CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 END AS INTEGER)
                AS severity_rank
    FROM (SELECT *, CASE WHEN days_of_inventory > -1 AND days_of_inventory <= 0 THEN 'Critical'
                         WHEN days_of_inventory > 0 AND days_of_inventory <= 2 THEN 'High'
                         WHEN days_of_inventory > 2 AND days_of_inventory <= 5 THEN 'Medium' END AS severity
          FROM (SELECT *, CAST(on_hand_units AS DOUBLE) / average_daily_demand AS days_of_inventory
                FROM wms_inventory_snapshots
                WHERE average_daily_demand > 0 AND on_hand_units <= average_daily_demand * 5))""",
    "pairs": """
    SELECT l.order_id, l.supplier_id, max(CAST(s.otif AS INTEGER)) AS otif, max(s.backorder_units) AS backorder_units
    FROM erp_order_lines l LEFT JOIN svc s ON s.order_id = l.order_id
    WHERE l.order_id IS NOT NULL AND l.supplier_id IS NOT NULL
    GROUP BY l.order_id, l.supplier_id""",
    "frame_long": """
    SELECT 'unit_fill_rate' AS metric, unit_fill_rate AS value FROM kpi_wide
    UNION ALL SELECT 'complete_order_rate', complete_order_rate FROM kpi_wide
    UNION ALL SELECT 'on_time_delivery_rate', on_time_delivery_rate FROM kpi_wide
    UNION ALL SELECT 'otif_rate', otif_rate FROM kpi_wide
    UNION ALL SELECT 'backorder_rate', backorder_rate FROM kpi_wide
    UNION ALL SELECT 'average_lead_time_days', average_lead_time_days FROM kpi_wide
    UNION ALL SELECT 'weighted_forecast_accuracy', weighted_forecast_accuracy FROM kpi_wide
    UNION ALL SELECT 'stockout_location_sku_rate', stockout_location_sku_rate FROM kpi_wide
    UNION ALL SELECT 'warehouse_productivity_units_per_hour', warehouse_productivity_units_per_hour FROM kpi_wide
    UNION ALL SELECT 'average_freight_cost_per_kg', average_freight_cost_per_kg FROM kpi_wide
    UNION ALL SELECT 'total_cost_to_serve', total_cost_to_serve FROM kpi_wide""",
    "recon": """
    SELECT metric, pv AS python_value, sv AS sql_value,
           round_even(abs(pv - sv), 12) AS absolute_difference, 1e-9::DOUBLE AS tolerance,
           CASE WHEN coalesce(abs(pv - sv) <= greatest(1e-9 * greatest(abs(pv), abs(sv)), 1e-9)
                              AND NOT isnan(pv) AND NOT isnan(sv), false) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT w.metric,
                 round_even(p.value, CASE w.metric WHEN 'total_orders' THEN 0 WHEN 'total_cost_to_serve' THEN 2 ELSE 12 END) AS pv,
                 round_even(q.value, CASE w.metric WHEN 'total_orders' THEN 0 WHEN 'total_cost_to_serve' THEN 2 ELSE 12 END) AS sv
          FROM (VALUES ('total_orders'), ('unit_fill_rate'), ('complete_order_rate'), ('on_time_delivery_rate'),
                       ('otif_rate'), ('backorder_rate'), ('average_lead_time_days'), ('total_cost_to_serve')) w(metric)
          LEFT JOIN (SELECT metric, value FROM frame_long
                     UNION ALL SELECT 'total_orders', total_orders FROM svc_kpi) p ON p.metric = w.metric
          LEFT JOIN (SELECT 'total_orders' AS metric, CAST(total_orders AS DOUBLE) AS value FROM mart_kpi
                     UNION ALL SELECT 'unit_fill_rate', unit_fill_rate FROM mart_kpi
                     UNION ALL SELECT 'complete_order_rate', complete_order_rate FROM mart_kpi
                     UNION ALL SELECT 'on_time_delivery_rate', on_time_delivery_rate FROM mart_kpi
                     UNION ALL SELECT 'otif_rate', otif_rate FROM mart_kpi
                     UNION ALL SELECT 'backorder_rate', backorder_rate FROM mart_kpi
                     UNION ALL SELECT 'average_lead_time_days', average_lead_time_days FROM mart_kpi
                     UNION ALL SELECT 'total_cost_to_serve', CAST(total_cost_to_serve AS DOUBLE) FROM mart_kpi) q
                 ON q.metric = w.metric)""",
}

CTES = {**ADAPTER, **ORDER_GRAIN, **KPI}

# ---------------------------------------------------------------------------
# Final SELECT of each registered query
# ---------------------------------------------------------------------------
_DAILY_ROLL = ("orders", "on_time_orders", "otif_orders", "units_ordered", "units_shipped")


def _daily(partition: str = "") -> str:
    keys = f"{partition}, " if partition else ""
    part = f"PARTITION BY {partition} " if partition else ""
    sums = ",\n".join(
        f"CAST(sum(o.{c}) AS BIGINT) AS rolling_30d_{c}" for c in _DAILY_ROLL
    )
    # the window under test restated as joins: by date range, and to the day before
    same, prior = (f"{a}.{partition} = t.{partition}" if partition else "true" for a in "oy")
    keyed = f"back_key = t.{partition}" if partition else "true"
    return f"""
    WITH daily AS (
        SELECT {keys}order_date, CAST(count(*) AS BIGINT) AS orders,
               CAST(sum(CAST(coalesce(on_time, false) AS INTEGER)) AS BIGINT) AS on_time_orders,
               CAST(sum(CAST(coalesce(otif, false) AS INTEGER)) AS BIGINT) AS otif_orders,
               CAST(sum(units_ordered) AS BIGINT) AS units_ordered,
               CAST(sum(units_shipped) AS BIGINT) AS units_shipped,
               {_rate('sum(CAST(coalesce(on_time, false) AS INTEGER))', 'count(*)')} AS daily_otd_rate,
               {_rate('sum(CAST(coalesce(otif, false) AS INTEGER))', 'count(*)')} AS daily_otif_rate,
               {_rate('sum(units_shipped)', 'sum(units_ordered)')} AS daily_fill_rate
        FROM mart GROUP BY {keys}order_date),
    numbered AS (
        SELECT *, row_number() OVER ({part}ORDER BY order_date ASC NULLS LAST) AS n FROM daily),
    back AS (
        SELECT t.{partition or "n"} AS back_key, t.n AS back_n, {sums}
        FROM numbered t JOIN numbered o
          ON {same} AND (o.order_date BETWEEN t.order_date - INTERVAL 29 DAYS AND t.order_date
                         OR (o.order_date IS NULL AND t.order_date IS NULL))
        GROUP BY t.{partition or "n"}, t.n)
    SELECT t.* EXCLUDE (n), back.* EXCLUDE (back_key, back_n),
           {_rate('rolling_30d_on_time_orders', 'rolling_30d_orders')} AS rolling_30d_otd_rate,
           {_rate('rolling_30d_otif_orders', 'rolling_30d_orders')} AS rolling_30d_otif_rate,
           {_rate('rolling_30d_units_shipped', 'rolling_30d_units_ordered')} AS rolling_30d_fill_rate,
           t.daily_otd_rate - y.daily_otd_rate AS day_over_day_otd_change,
           t.daily_otif_rate - y.daily_otif_rate AS day_over_day_otif_change
    FROM numbered t JOIN back ON back_n = t.n AND {keyed}
    LEFT JOIN numbered y ON y.n = t.n - 1 AND {prior}"""


def _queue(where: str, rows: str = "svc") -> str:
    return f"""
    SELECT order_id, customer_id, warehouse, carrier, order_date, promised_date, delivery_date,
           units_ordered, units_shipped, backorder_units, cost_to_serve,
           CASE WHEN NOT on_time AND NOT in_full THEN 'both' WHEN NOT on_time THEN 'late' ELSE 'short' END AS reason
    FROM {rows} WHERE {where}"""


def _region_segment(rows: str, extra: str = "") -> str:
    return f"""
    SELECT c.region, c.customer_segment, CAST(count(*) AS BIGINT) AS orders,
           {_flag_rate('s.otif')} AS otif_rate, {_flag_rate('s.on_time')} AS on_time_delivery_rate,
           {_rate('sum(s.units_shipped)', 'sum(s.units_ordered)')} AS unit_fill_rate,
           CAST(sum(s.cost_to_serve) AS DECIMAL(38,2)) AS cost_to_serve
    FROM {rows} s LEFT JOIN customers c ON c.customer_id = s.customer_id {extra}
    GROUP BY c.region, c.customer_segment"""


def _low_cover(where: str = "") -> str:
    return f"""
    SELECT warehouse, severity, severity_rank, CAST(count(*) AS BIGINT) AS exceptions,
           CAST(sum(on_hand_units) AS BIGINT) AS on_hand_units,
           round(avg(days_of_inventory), 9) AS average_days_of_inventory,
           round(sum(average_daily_demand), 9) AS total_average_daily_demand
    FROM stockouts {where} GROUP BY warehouse, severity, severity_rank"""


def _pareto(by: str) -> str:
    order = f"exception_cost DESC NULLS LAST, {by} ASC"
    return f"""
    SELECT {by}, exception_cost, orders_with_exception,
           {_rate('exception_cost', 'sum(exception_cost) OVER ()')} AS share,
           {_rate(f'sum(exception_cost) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)',
                  'sum(exception_cost) OVER ()')} AS cumulative_share,
           CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS pareto_rank
    FROM (SELECT {by}, CAST(sum(exception_cost) AS DECIMAL(38,2)) AS exception_cost,
                 CAST(count(*) FILTER (WHERE exception_cost > 0) AS BIGINT) AS orders_with_exception
          FROM svc WHERE {by} IS NOT NULL GROUP BY {by})"""


def _accuracy_cols() -> str:
    return f"""CAST(coalesce(sum(forecast_units), 0) AS BIGINT) AS forecast_units,
           CAST(coalesce(sum(actual_units), 0) AS BIGINT) AS actual_units,
           CAST(coalesce(sum(abs(forecast_units - actual_units)), 0) AS BIGINT) AS absolute_error_units,
           CASE WHEN coalesce(sum(actual_units), 0) = 0
                THEN CASE WHEN coalesce(sum(abs(forecast_units - actual_units)), 0) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - {_rate('sum(abs(forecast_units - actual_units))', 'sum(actual_units)')})
           END AS weighted_forecast_accuracy"""


def _shock(keys: str) -> str:
    return f"""
    SELECT month, product_category{keys},
           CAST(sum(forecast_units) AS BIGINT) AS forecast_units, CAST(sum(actual_units) AS BIGINT) AS actual_units,
           {_rate('sum(forecast_units)', 'sum(actual_units)')} AS forecast_to_actual,
           {_rate('sum(forecast_units) - sum(actual_units)', 'sum(actual_units)')} AS forecast_bias
    FROM demand_forecasts f LEFT JOIN (SELECT sku, product_category FROM products) p USING (sku)
    GROUP BY month, product_category{keys}"""


def _dq_report() -> str:
    """The 38 checks, one row each."""
    n = "CAST({} AS VARCHAR)"
    fmt = "coalesce(printf('%.4f', CAST({} AS DOUBLE)), 'nan')"

    def metric(m: str) -> str:
        return f"(SELECT max(value) FROM frame_long WHERE metric = '{m}')"

    def unit(m: str) -> str:
        x = metric(m)
        return f"coalesce({x} >= 0 AND {x} <= 1 AND NOT isnan({x}) AND abs({x}) < 'inf'::DOUBLE, false)"

    def dup(table: str, keys: str) -> str:
        return f"(SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1))"

    def missing(child: str, fk: str, parent: str, pk: str) -> str:
        return (f"(SELECT count(*) FROM (SELECT DISTINCT {fk} AS k FROM {child}) c "
                f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.k))")

    def nn(c: str) -> str:
        return f"coalesce({c} >= 0 AND NOT isnan(CAST({c} AS DOUBLE)), false)"

    checks = [
        ("customer_key_unique", f"{dup('customers', 'customer_id')} = 0", "'rows=' || " + n.format("(SELECT count(*) FROM customers)")),
        ("supplier_key_unique", f"{dup('suppliers', 'supplier_id')} = 0", "'rows=' || " + n.format("(SELECT count(*) FROM suppliers)")),
        ("product_key_unique", f"{dup('products', 'sku')} = 0", "'rows=' || " + n.format("(SELECT count(*) FROM products)")),
        ("order_line_key_unique", f"{dup('erp_order_lines', 'order_line_id')} = 0",
         "'rows=' || " + n.format("(SELECT count(*) FROM erp_order_lines)")),
        ("shipment_order_unique", f"{dup('tms_shipments', 'order_id')} = 0",
         "'orders=' || " + n.format("(SELECT count(DISTINCT order_id) FROM tms_shipments)")),
        ("shipment_orders_exist", f"{missing('tms_shipments', 'order_id', 'erp_order_lines', 'order_id')} = 0",
         "'every shipment references an ERP order'"),
        ("order_shipment_coverage",
         f"{missing('tms_shipments', 'order_id', 'erp_order_lines', 'order_id')} = 0 AND "
         f"{missing('erp_order_lines', 'order_id', 'tms_shipments', 'order_id')} = 0",
         "'every modeled order has exactly one shipment'"),
        ("order_customers_exist", f"{missing('erp_order_lines', 'customer_id', 'customers', 'customer_id')} = 0",
         "'every order references a customer'"),
        ("order_products_exist", f"{missing('erp_order_lines', 'sku', 'products', 'sku')} = 0",
         "'every order line references a product'"),
        ("order_suppliers_exist", f"{missing('erp_order_lines', 'supplier_id', 'suppliers', 'supplier_id')} = 0",
         "'every order line references a supplier'"),
        ("inventory_grain_unique", f"{dup('wms_inventory_snapshots', 'snapshot_date, warehouse, sku')} = 0",
         "'grain=snapshot_date,warehouse,sku'"),
        ("forecast_grain_unique", f"{dup('demand_forecasts', 'month, warehouse, sku')} = 0", "'grain=month,warehouse,sku'"),
        ("activity_grain_unique", f"{dup('warehouse_activity', 'activity_date, warehouse')} = 0",
         "'grain=activity_date,warehouse'"),
        ("units_non_negative",
         f"(SELECT count(*) FROM erp_order_lines WHERE NOT ({nn('units_ordered')} AND {nn('units_shipped')})) = 0",
         "'ordered and shipped units >= 0'"),
        ("shipped_not_above_ordered",
         "(SELECT count(*) FROM erp_order_lines WHERE NOT coalesce(units_shipped <= units_ordered, false)) = 0",
         "'line-level shipped <= ordered'"),
        ("promised_not_before_order",
         "(SELECT count(*) FROM erp_order_lines WHERE NOT coalesce(promised_date >= order_date, false)) = 0",
         "'promised date >= order date'"),
        ("shipment_promise_matches_erp",
         "(SELECT count(*) FROM (SELECT order_id FROM erp_order_lines GROUP BY order_id "
         "HAVING count(DISTINCT promised_date) <> 1)) = 0 AND "
         "(SELECT count(*) FROM tms_shipments s LEFT JOIN (SELECT order_id, min(promised_date) AS p "
         "FROM erp_order_lines GROUP BY order_id) e ON e.order_id = s.order_id "
         "WHERE NOT coalesce(s.promised_date = e.p, false)) = 0",
         "'one ERP promise per order and TMS promise matches it'"),
        ("delivery_not_before_ship",
         "(SELECT count(*) FROM tms_shipments WHERE NOT coalesce(delivery_date >= ship_date, false)) = 0",
         "'delivery date >= ship date'"),
        ("source_on_time_consistent",
         "(SELECT count(*) FROM tms_shipments WHERE coalesce(lower(CAST(on_time AS VARCHAR)) = 'true', false) "
         "<> coalesce(delivery_date <= promised_date, false)) = 0",
         "'source flag matches delivery <= promise'"),
        ("inventory_non_negative",
         f"(SELECT count(*) FROM wms_inventory_snapshots WHERE NOT ({nn('on_hand_units')} AND "
         f"{nn('average_daily_demand')} AND {nn('inventory_value')})) = 0",
         "'inventory measures >= 0'"),
        ("forecast_non_negative",
         f"(SELECT count(*) FROM demand_forecasts WHERE NOT ({nn('forecast_units')} AND {nn('actual_units')})) = 0",
         "'forecast and actual units >= 0'"),
        ("activity_valid",
         f"(SELECT count(*) FROM warehouse_activity WHERE NOT ({nn('units_processed')} AND "
         "coalesce(labor_hours > 0, false))) = 0",
         "'processed units >= 0 and labor hours > 0'"),
        ("summary_metric_unique", f"{dup('frame_long', 'metric')} = 0",
         "'metrics=' || " + n.format("(SELECT count(*) FROM frame_long)")),
        ("summary_metrics_complete", "(SELECT count(DISTINCT metric) FROM frame_long) = 11", "'required=11'"),
        ("summary_values_finite",
         "(SELECT count(*) FROM frame_long WHERE NOT coalesce(NOT isnan(value) AND abs(value) < 'inf'::DOUBLE, false)) = 0",
         "'all reported KPI values are finite'"),
        ("order_output_unique", f"{dup('svc', 'order_id')} = 0", "'orders=' || " + n.format("(SELECT count(*) FROM svc)")),
    ]
    for check, m in (
        ("unit_fill_rate_range", "unit_fill_rate"),
        ("complete_order_rate_range", "complete_order_rate"),
        ("on_time_delivery_rate_range", "on_time_delivery_rate"),
        ("otif_rate_range", "otif_rate"),
        ("backorder_rate_range", "backorder_rate"),
        ("forecast_accuracy_range", "weighted_forecast_accuracy"),
        ("stockout_rate_range", "stockout_location_sku_rate"),
    ):
        checks.append((check, unit(m), "'value=' || " + fmt.format(metric(m))))
    demanded = "(SELECT count(*) FROM wms_inventory_snapshots WHERE average_daily_demand > 0)"
    outs = "(SELECT count(*) FROM wms_inventory_snapshots WHERE average_daily_demand > 0 AND on_hand_units <= 0)"
    checks += [
        ("stockout_rate_matches_demanded_inventory",
         f"abs({metric('stockout_location_sku_rate')} - CASE WHEN {demanded} > 0 "
         f"THEN CAST({outs} AS DOUBLE) / CAST({demanded} AS DOUBLE) ELSE 0.0 END) < 1e-9",
         f"'stockouts=' || {n.format(outs)} || '; demanded_combinations=' || {n.format(demanded)}"),
        ("otif_not_above_components",
         f"{metric('otif_rate')} <= least({metric('complete_order_rate')}, {metric('on_time_delivery_rate')}) + 1e-9",
         "'OTIF <= in-full and on-time'"),
        ("backorder_complements_fill",
         f"abs(({metric('unit_fill_rate')} + {metric('backorder_rate')}) - 1) < 1e-9",
         "'fill + backorder = 1 under the documented model'"),
        ("carrier_output_non_empty", "(SELECT count(*) FROM carriers) > 0",
         "'carriers=' || " + n.format("(SELECT count(*) FROM carriers)")),
        ("sql_python_reconciliation_passed",
         "(SELECT count(*) FROM recon) > 0 AND (SELECT count(*) FROM recon WHERE status <> 'PASS') = 0",
         "'metrics=' || " + n.format("(SELECT count(*) FROM recon)")),
    ]
    rows = [
        f"SELECT CAST({i} AS INTEGER) AS check_order, '{name}' AS \"check\", "
        f"CASE WHEN coalesce({ok}, false) THEN 'PASS' ELSE 'FAIL' END AS status, {det} AS detail"
        for i, (name, ok, det) in enumerate(checks, start=1)
    ]
    return "\nUNION ALL ".join(rows)


# Values of the extracts that do not parse, by source and column (``cargoline.plans.extracts``).
CSV_DIRT = {
    "customers": {}, "suppliers": {"base_lead_time_days": "supplier_id % 7 = 0"}, "products": {},
    "erp_order_lines": {"promised_date": "order_id % 101 = 0", "units_ordered": "order_id % 103 = 0"},
    "tms_shipments": {"on_time": "order_id % 97 = 0"},
    "wms_inventory_snapshots": {}, "demand_forecasts": {}, "warehouse_activity": {},
}

FINAL = {
    # sources
    "customers": "SELECT * FROM customers",
    "suppliers": "SELECT * FROM suppliers",
    "products": "SELECT * FROM products",
    "erp_order_lines": "SELECT * FROM erp_order_lines",
    "tms_shipments": "SELECT * FROM tms_shipments",
    "wms_inventory_snapshots": "SELECT * FROM wms_inventory_snapshots",
    "demand_forecasts": "SELECT * FROM demand_forecasts",
    "warehouse_activity": "SELECT * FROM warehouse_activity",
    # order grain
    "order_rollup": "SELECT * FROM roll_m",
    "order_service": "SELECT * FROM svc",
    "mart_order_service": "SELECT * FROM mart",
    # KPIs
    "kpi_summary": "SELECT * FROM frame_long",
    "mart_kpi_summary": "SELECT * FROM mart_kpi",
    "weighted_forecast_accuracy": "SELECT * FROM fc_acc",
    "stockout_rate": f"""
    SELECT warehouse,
           CAST(count(*) FILTER (WHERE average_daily_demand > 0) AS BIGINT) AS demanded_combinations,
           CAST(count(*) FILTER (WHERE average_daily_demand > 0 AND on_hand_units <= 0) AS BIGINT) AS stockouts,
           coalesce({_rate("count(*) FILTER (WHERE average_daily_demand > 0 AND on_hand_units <= 0)",
                           "count(*) FILTER (WHERE average_daily_demand > 0)")}, 0.0::DOUBLE) AS stockout_location_sku_rate
    FROM wms_inventory_snapshots GROUP BY warehouse""",
    "warehouse_productivity": f"""
    SELECT warehouse, activity_date, CAST(sum(units_processed) AS BIGINT) AS units_processed,
           CAST(sum(labor_hours) AS DECIMAL(38,2)) AS labor_hours,
           coalesce({_rate('sum(units_processed)', 'sum(labor_hours)')}, 0.0::DOUBLE) AS units_per_labor_hour
    FROM warehouse_activity GROUP BY warehouse, activity_date""",
    # scorecards
    "carrier_scorecard": "SELECT * FROM carriers",
    "mart_carrier_scorecard": f"""
    WITH cm AS (
        SELECT carrier, CAST(count(*) AS BIGINT) AS orders,
               {_flag_rate('otif')} AS otif_rate, {_flag_rate('on_time')} AS on_time_delivery_rate,
               {_rate('sum(lead_time_days)', 'count(lead_time_days)')} AS average_lead_time_days,
               round(avg(freight_cost_per_kg), 9) AS average_freight_cost_per_kg,
               CAST(sum(exception_cost) AS DECIMAL(38,2)) AS total_exception_cost,
               round(quantile_cont(freight_cost_per_kg, 0.9), 9) AS p90_freight_cost_per_kg
        FROM mart GROUP BY carrier)
    SELECT *, CAST(dense_rank() OVER (ORDER BY otif_rate DESC NULLS LAST) AS BIGINT) AS service_rank,
              CAST(dense_rank() OVER (ORDER BY average_freight_cost_per_kg ASC NULLS LAST) AS BIGINT) AS cost_rank
    FROM cm""",
    "mart_daily_service": _daily(),
    "mart_daily_service_by_warehouse": _daily("warehouse"),
    "customer_cost_to_serve": f"""
    SELECT cc.*, CASE WHEN revenue > 0 THEN {_rate('cost_to_serve', 'revenue')} END AS cost_to_serve_pct_revenue,
           c.customer_segment, c.region
    FROM (SELECT customer_id, CAST(count(order_id) AS BIGINT) AS orders,
                 CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue,
                 CAST(sum(cost_to_serve) AS DECIMAL(38,2)) AS cost_to_serve,
                 {_flag_rate('otif')} AS otif_rate, CAST(sum(backorder_units) AS BIGINT) AS backorder_units
          FROM svc WHERE customer_id IS NOT NULL GROUP BY customer_id) cc
    LEFT JOIN customers c ON c.customer_id = cc.customer_id""",
    "stockout_exceptions": "SELECT * FROM stockouts",
    "supplier_risk_scorecard": f"""
    WITH ps AS (SELECT supplier_id, CAST(count(*) AS BIGINT) AS orders,
                       {_rate('sum(otif)', 'count(otif)')} AS otif_rate,
                       CAST(sum(backorder_units) AS BIGINT) AS backorder_units
                FROM pairs GROUP BY supplier_id),
         sc AS (SELECT ps.*, su.supplier_name, su.base_lead_time_days, su.supplier_risk_tier
                FROM ps LEFT JOIN suppliers su ON su.supplier_id = ps.supplier_id),
         mx AS (SELECT max(backorder_units) AS mb FROM sc)
    SELECT sc.*,
           least(greatest(0.6::DOUBLE * (1.0::DOUBLE - otif_rate)
                          + 0.25::DOUBLE * {_rate('backorder_units', 'greatest(mb, 1)')}
                          + 0.15::DOUBLE * CASE supplier_risk_tier WHEN 'Low' THEN 0.0::DOUBLE
                                                WHEN 'Medium' THEN 0.15::DOUBLE WHEN 'High' THEN 0.3::DOUBLE
                                                ELSE 0.0::DOUBLE END,
                          0.0::DOUBLE), 1.0::DOUBLE) AS resilience_risk_score
    FROM sc CROSS JOIN mx""",
    "supplier_line_shortage": f"""
    WITH own AS (SELECT supplier_id, CAST(count(*) AS BIGINT) AS order_lines,
                        CAST(sum(units_ordered) AS BIGINT) AS units_ordered,
                        CAST(sum(units_shipped) AS BIGINT) AS units_shipped,
                        CAST(sum(greatest(units_ordered - units_shipped, 0)) AS BIGINT) AS line_backorder_units
                 FROM erp_order_lines WHERE supplier_id IS NOT NULL GROUP BY supplier_id),
         att AS (SELECT supplier_id, CAST(sum(backorder_units) AS BIGINT) AS attributed_backorder_units
                 FROM pairs GROUP BY supplier_id)
    SELECT own.*, att.attributed_backorder_units, su.supplier_name, su.supplier_risk_tier,
           {_rate('att.attributed_backorder_units', 'own.line_backorder_units')} AS attribution_ratio
    FROM own LEFT JOIN att ON att.supplier_id = own.supplier_id
    LEFT JOIN suppliers su ON su.supplier_id = own.supplier_id""",
    "service_segments": f"""
    SELECT in_full, on_time, CAST(count(*) AS BIGINT) AS orders,
           {_rate('count(*)', 'sum(count(*)) OVER ()')} AS share
    FROM svc GROUP BY in_full, on_time""",
    # inventory and planning
    "days_of_inventory": """
    SELECT *, CASE WHEN average_daily_demand > 0 THEN CAST(on_hand_units AS DOUBLE) / average_daily_demand END
                AS days_of_inventory
    FROM wms_inventory_snapshots""",
    "inventory_cover": """
    SELECT *, CASE WHEN average_daily_demand > 0 THEN CAST(on_hand_units AS DOUBLE) / average_daily_demand END
                AS days_of_inventory
    FROM (SELECT warehouse, sku, max(snapshot_date) AS snapshot_date,
                 arg_max(on_hand_units, snapshot_date) AS on_hand_units,
                 arg_max(average_daily_demand, snapshot_date) AS average_daily_demand
          FROM wms_inventory_snapshots GROUP BY warehouse, sku)""",
    "stockout_low_cover": _low_cover(),
    "forecast_accuracy_by_category": f"""
    SELECT product_category, {_accuracy_cols()}
    FROM demand_forecasts f LEFT JOIN (SELECT sku, product_category FROM products) p USING (sku)
    GROUP BY product_category""",
    "demand_shock_trend": _shock(""),
    "forecast_bias_by_warehouse": _shock(", warehouse"),
    "shipment_weight": """
    SELECT order_id, CAST(sum(units_shipped * unit_weight_kg) AS DECIMAL(38,2)) AS shipment_weight_kg
    FROM erp_order_lines GROUP BY order_id""",
    "delivery_chronology": """
    SELECT shipment_id, order_id, carrier, ship_date, promised_date, delivery_date,
           CAST(date_diff('day', ship_date, delivery_date) AS BIGINT) AS transit_days,
           CAST(date_diff('day', promised_date, delivery_date) AS BIGINT) AS effective_delay_days,
           date_diff('day', promised_date, delivery_date) > 0 AS is_late,
           delivery_date < ship_date AS delivered_before_ship,
           (exception_cost > 0) = (date_diff('day', promised_date, delivery_date) > 0) AS exception_cost_consistent,
           on_time = NOT (date_diff('day', promised_date, delivery_date) > 0) AS on_time_flag_consistent,
           exception_cost
    FROM tms_shipments""",
    "demand_grid": "SELECT month, warehouse, sku, CAST(demand AS BIGINT) AS demand_units FROM grid",
    "average_daily_demand": """
    SELECT month, warehouse, sku, CAST(demand AS BIGINT) AS demand_units, CAST(days_in_month AS BIGINT) AS days_in_month,
           demand / days_in_month AS average_daily_demand
    FROM grid""",
    "warehouse_activity_rollup": """
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS activity_month, warehouse,
           CAST(sum(units_shipped) AS BIGINT) AS units_processed, CAST(count(*) AS BIGINT) AS order_lines
    FROM erp_order_lines GROUP BY 1, 2""",
    # dashboard views
    "service_by_region_segment": _region_segment("svc"),
    "filtered_service_by_region_segment": _region_segment(
        "svc", "WHERE c.region IN ('EUROPE', 'ASIA') AND c.customer_segment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')"),
    "filtered_exception_queue": _queue("""NOT otif AND warehouse IN ('WH-CENTRAL', 'WH-SOUTH') AND EXISTS (
        SELECT 1 FROM erp_order_lines l JOIN products p ON p.sku = l.sku
        WHERE l.order_id = svc.order_id AND l.supplier_id IN (1, 2, 3, 5, 8)
          AND p.product_category IN ('STANDARD', 'PROMO', 'ECONOMY'))"""),
    "filtered_stockout_low_cover": _low_cover("""WHERE severity IN ('Critical', 'High')
        AND snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'
        AND sku IN (SELECT sku FROM products WHERE product_category IN ('STANDARD', 'PROMO'))"""),
    "carrier_quadrant": f"""
    SELECT c.carrier, c.orders, c.otif_rate, c.average_freight_cost_per_kg,
           p.portfolio_otif_rate, p.portfolio_freight_cost_per_kg,
           CASE WHEN c.otif_rate >= p.portfolio_otif_rate AND c.average_freight_cost_per_kg <= p.portfolio_freight_cost_per_kg
                  THEN 'high service / low cost'
                WHEN c.otif_rate >= p.portfolio_otif_rate AND c.average_freight_cost_per_kg > p.portfolio_freight_cost_per_kg
                  THEN 'high service / high cost'
                WHEN c.otif_rate < p.portfolio_otif_rate AND c.average_freight_cost_per_kg <= p.portfolio_freight_cost_per_kg
                  THEN 'low service / low cost'
                WHEN c.otif_rate < p.portfolio_otif_rate AND c.average_freight_cost_per_kg > p.portfolio_freight_cost_per_kg
                  THEN 'low service / high cost' END AS quadrant
    FROM carriers c CROSS JOIN (SELECT {_flag_rate('otif')} AS portfolio_otif_rate,
                                       round(avg(freight_cost_per_kg), 9) AS portfolio_freight_cost_per_kg
                                FROM svc WHERE carrier IS NOT NULL) p""",
    "exception_queue": _queue("NOT otif"),
    "late_full_queue": _queue("NOT on_time AND in_full"),
    "freight_per_kg_by_carrier": f"""
    SELECT carrier, CAST(count(*) AS BIGINT) AS shipments,
           CAST(sum(freight_cost) AS DECIMAL(38,2)) AS freight_cost,
           CAST(sum(shipment_weight_kg) AS DECIMAL(38,2)) AS shipment_weight_kg,
           round(avg(freight_cost_per_kg), 9) AS average_freight_cost_per_kg,
           {_rate('sum(freight_cost)', 'sum(shipment_weight_kg)')} AS freight_cost_per_kg,
           round(quantile_cont(freight_cost_per_kg, 0.9), 9) AS p90_freight_cost_per_kg
    FROM svc WHERE carrier IS NOT NULL AND shipment_weight_kg > 0 GROUP BY carrier""",
    "lead_time_distribution": f"""
    SELECT lead_time_days, orders, {_rate('orders', 'sum(orders) OVER ()')} AS share,
           CAST(sum(orders) OVER (ORDER BY lead_time_days ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
             AS cumulative_orders,
           {_rate('sum(orders) OVER (ORDER BY lead_time_days ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)',
                  'sum(orders) OVER ()')} AS cumulative_share,
           (SELECT quantile_cont(CAST(lead_time_days AS DOUBLE), 0.5) FROM svc) AS p50_lead_time_days,
           (SELECT quantile_cont(CAST(lead_time_days AS DOUBLE), 0.9) FROM svc) AS p90_lead_time_days
    FROM (SELECT lead_time_days, CAST(count(*) AS BIGINT) AS orders FROM svc
          WHERE lead_time_days IS NOT NULL GROUP BY lead_time_days)""",
    "exception_cost_pareto": _pareto("carrier"),
    "exception_cost_pareto_by_warehouse": _pareto("warehouse"),
    "filtered_order_service": """
    SELECT * FROM svc
    WHERE order_date >= DATE '1996-01-01' AND order_date <= DATE '1997-12-31'
      AND warehouse IN ('WH-NORTH', 'WH-SOUTH') AND carrier IN ('A', 'C')""",
    "carrier_stratified": f"""
    WITH cells AS (
        SELECT warehouse, weight_band, carrier, CAST(count(*) AS BIGINT) AS orders,
               CAST(sum(CAST(otif AS INTEGER)) AS BIGINT) AS otif_orders,
               CAST(sum(CASE WHEN shipment_weight_kg > 0 THEN freight_cost END) AS DECIMAL(38,2)) AS freight_cost,
               CAST(sum(CASE WHEN shipment_weight_kg > 0 THEN shipment_weight_kg END) AS DECIMAL(38,2)) AS shipment_weight_kg
        FROM (SELECT *, CASE WHEN shipment_weight_kg IS NULL OR shipment_weight_kg <= 0 THEN 'zero'
                             WHEN shipment_weight_kg <= 100 THEN '0-100'
                             WHEN shipment_weight_kg <= 500 THEN '100-500'
                             WHEN shipment_weight_kg <= 1000 THEN '500-1000' ELSE '1000+' END AS weight_band
              FROM svc WHERE carrier IS NOT NULL)
        GROUP BY warehouse, weight_band, carrier),
    rated AS (
        SELECT warehouse, weight_band, carrier, orders,
               {_rate('otif_orders', 'orders')} AS otif_rate,
               {_rate('freight_cost', 'shipment_weight_kg')} AS freight_cost_per_kg,
               {_rate('sum(otif_orders) OVER s', 'sum(orders) OVER s')} AS stratum_otif_rate,
               {_rate('sum(freight_cost) OVER s', 'sum(shipment_weight_kg) OVER s')} AS stratum_freight_cost_per_kg
        FROM cells WINDOW s AS (PARTITION BY warehouse, weight_band))
    SELECT *, otif_rate - stratum_otif_rate AS otif_vs_stratum,
              freight_cost_per_kg - stratum_freight_cost_per_kg AS freight_per_kg_vs_stratum
    FROM rated""",
    "critical_stockout_customers": """
    WITH crit AS (SELECT snapshot_date AS month, warehouse, sku FROM stockouts WHERE severity = 'Critical'),
         rev AS (SELECT customer_id, CAST(sum(revenue) AS DECIMAL(38,2)) AS customer_revenue
                 FROM erp_order_lines WHERE customer_id IS NOT NULL GROUP BY customer_id),
         thr AS (SELECT quantile_cont(CAST(customer_revenue AS DOUBLE), 0.9) AS t FROM rev),
         top AS (SELECT rev.customer_id, rev.customer_revenue, round(thr.t, 6) AS revenue_threshold
                 FROM rev CROSS JOIN thr WHERE CAST(rev.customer_revenue AS DOUBLE) >= thr.t),
         hit AS (SELECT l.* FROM erp_order_lines l
                 WHERE EXISTS (SELECT 1 FROM crit c WHERE c.month = CAST(date_trunc('month', l.order_date) AS DATE)
                                                      AND c.warehouse = l.warehouse AND c.sku = l.sku)
                   AND l.customer_id IN (SELECT customer_id FROM top))
    SELECT h.customer_id, CAST(count(*) AS BIGINT) AS critical_lines,
           CAST(count(DISTINCT h.order_id) AS BIGINT) AS critical_orders,
           CAST(sum(h.units_ordered) AS BIGINT) AS critical_units_ordered,
           CAST(sum(greatest(h.units_ordered - h.units_shipped, 0)) AS BIGINT) AS critical_units_short,
           any_value(t.customer_revenue) AS customer_revenue, any_value(t.revenue_threshold) AS revenue_threshold,
           any_value(c.customer_segment) AS customer_segment, any_value(c.region) AS region
    FROM hit h JOIN top t ON t.customer_id = h.customer_id
    LEFT JOIN customers c ON c.customer_id = h.customer_id
    GROUP BY h.customer_id""",
    # governance
    "reconcile_metrics": "SELECT * FROM recon",
    "mart_grain_check": """
    SELECT CAST(count(*) FILTER (WHERE c <> 1) AS BIGINT) AS duplicate_orders
    FROM (SELECT order_id, count(*) AS c FROM mart GROUP BY order_id)""",
    "data_quality_report": _dq_report(),
    "csv_kpi_summary": "SELECT * FROM frame_long",
    "csv_extract_report": " UNION ALL ".join(
        f"SELECT '{source}' AS source, count(*) AS rows_read, count(*) FILTER (WHERE {' OR '.join(bad.values()) or 'false'}) AS rows_rejected, "
        + ("concat_ws(', ', " + ", ".join(
            f"CASE WHEN count(*) FILTER (WHERE {rule}) > 0 THEN '{column}=' || count(*) FILTER (WHERE {rule}) END" for column, rule in sorted(bad.items())) + ")"
           if bad else "''") + f" AS problems FROM {source}"
        for source, bad in CSV_DIRT.items()),
    "csv_rejected_lines": """
    SELECT order_line_id, concat_ws(', ', CASE WHEN order_id % 101 = 0 THEN 'promised_date' END,
                                          CASE WHEN order_id % 103 = 0 THEN 'units_ordered' END) AS problems
    FROM erp_order_lines WHERE order_id % 101 = 0 OR order_id % 103 = 0""",
}


# Money columns (exact DECIMAL inside both engines): each query hands them over as whole
# numbers of the smallest unit, cents or (inventory value) ten-thousandths.
MONEY_OUTPUTS = {
    'carrier_scorecard': ('total_exception_cost',),
    'critical_stockout_customers': ('customer_revenue',),
    'customer_cost_to_serve': ('revenue', 'cost_to_serve'),
    'days_of_inventory': ('inventory_value',),
    'delivery_chronology': ('exception_cost',),
    'erp_order_lines': ('unit_price', 'unit_weight_kg', 'revenue'),
    'exception_cost_pareto': ('exception_cost',),
    'exception_cost_pareto_by_warehouse': ('exception_cost',),
    'exception_queue': ('cost_to_serve',),
    'filtered_exception_queue': ('cost_to_serve',),
    'filtered_service_by_region_segment': ('cost_to_serve',),
    'filtered_order_service': ('revenue', 'freight_cost', 'handling_cost', 'exception_cost', 'cost_to_serve', 'shipment_weight_kg'),
    'freight_per_kg_by_carrier': ('freight_cost', 'shipment_weight_kg'),
    'late_full_queue': ('cost_to_serve',),
    'mart_carrier_scorecard': ('total_exception_cost',),
    'mart_kpi_summary': ('total_cost_to_serve',),
    'mart_order_service': ('revenue', 'freight_cost', 'handling_cost', 'exception_cost', 'shipment_weight_kg', 'cost_to_serve'),
    'order_rollup': ('revenue',),
    'order_service': ('revenue', 'freight_cost', 'handling_cost', 'exception_cost', 'cost_to_serve', 'shipment_weight_kg'),
    'products': ('unit_price', 'unit_weight_kg'),
    'service_by_region_segment': ('cost_to_serve',),
    'shipment_weight': ('shipment_weight_kg',),
    'stockout_exceptions': ('inventory_value',),
    'tms_shipments': ('shipment_weight_kg', 'freight_cost', 'handling_cost', 'exception_cost'),
    'warehouse_activity': ('labor_hours',),
    'warehouse_productivity': ('labor_hours',),
    'wms_inventory_snapshots': ('inventory_value',),
}


def _with(final: str) -> str:
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in CTES.items())
    body = final.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _interchange(name: str, sql: str) -> str:
    money = MONEY_OUTPUTS.get(name)
    if not money:
        return sql
    unit = {"inventory_value": (10000, "_e4")}
    casts = ", ".join(f"CAST({c} * {unit.get(c, (100, ''))[0]} AS BIGINT) AS {c}{unit.get(c, (0, '_cents'))[1]}" for c in money)
    return f"SELECT * EXCLUDE ({', '.join(money)}), {casts} FROM (\n{sql}\n) AS q"


def oracle_sql() -> dict[str, str]:
    return {name: _interchange(name, _with(final)) for name, final in FINAL.items()}
