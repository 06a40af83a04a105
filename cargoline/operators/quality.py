"""Data-quality checks (O18) and the mart grain check.

The report is data -- (check, status, detail) rows -- and reads every source but the lines once:

* the order lines are folded by each of their keys: line and order alone, customer, SKU and
  supplier in one pass of grouping sets; the row predicates ride along.  The folds
  are written, as several checks read them;
* shipments are folded to one row per order; a full join with the order fold answers
  coverage, promises and shipment uniqueness;
* customers, products and suppliers are folded by key; a full join with the line fold of
  that key answers uniqueness and references;
* dated tables prove their grain by bitmaps: 64 months (or 64 whole-number ids) of a key are
  the bits of one number, so the exchange has one row where the table has up to 64;
* every result is a few named numbers; they meet in one row, from which the 38 report
  rows are made.

``raise_on_fail`` turns any FAIL into an error at collection time.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import as_double, holds, is_finite, non_negative
from cargoline.operators.kpis import SUMMARY_METRICS
from cargoline.session import written_once

# The check names and their detail texts in data_quality_report, and the tolerance.
TOLERANCE = 1e-9


def mart_grain_check(mart: DataFrame, key: str = "order_id") -> DataFrame:
    """Number of keys that do not have exactly one row (0 = grain holds)."""
    return mart.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).agg(
        F.count_if(F.col("_rows") != 1).cast(T.LongType()).alias("duplicate_orders")
    )


def _facts(df: DataFrame, **numbers: Column) -> tuple[list[str], DataFrame]:
    """(names, one row with the named whole numbers as a map; 0 for NULL)."""
    cells = [x for name, c in numbers.items() for x in (F.lit(name), F.coalesce(c.cast(T.LongType()), F.lit(0).cast(T.LongType())))]
    return list(numbers), df.agg(F.create_map(*cells).alias("facts"))


# --- uniqueness by bitmaps -----------------------------------------------------
def _bits(number: str) -> Column:
    """All values of ``number`` in a group of 64 consecutive ones, as bits of one BIGINT."""
    return F.bit_or(F.expr(f"shiftleft(1L, cast({number} & 63 as int))"))


def _surplus(rows: str = "_n", bits: str = "_bits") -> Column:
    """Rows beyond the first of their key; without bits (a NULL) the group is one key."""
    return F.sum(F.col(rows) - F.coalesce(F.bit_count(bits), F.lit(1)))


def by_date(df: DataFrame, date: str, keys: Sequence[str], *extra: Column) -> DataFrame:
    """``df`` by ``keys`` and up to 64 months of one day of the month: ``_n`` rows, the months as ``_bits``."""
    month = (F.year(date) * 12 + F.month(date)).cast("long")
    rows = df.withColumns({"_day": F.dayofmonth(date), "_month": month, "_era": F.shiftright(month, 6)})
    return rows.groupBy(*keys, "_day", "_era").agg(F.count(F.lit(1)).alias("_n"), _bits("_month").alias("_bits"), *extra)


def by_id(df: DataFrame, key: str) -> DataFrame:
    """``df`` by ``key``: whole numbers 64 to a row, any other type one."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        rows = df.select(F.col(key).cast("long").alias("_id")).withColumn("_era", F.shiftright("_id", 6))
        return rows.groupBy("_era").agg(F.count(F.lit(1)).alias("_n"), _bits("_id").alias("_bits"))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bits", F.lit(1).cast("long"))


# --- folds ------------------------------------------------------------------------
LINE_KEYS = ("order_line_id", "order_id", "customer_id", "sku", "supplier_id")


def line_folds(lines: DataFrame) -> dict[str, DataFrame]:
    """Per key of LINE_KEYS: one row per value (NULL is one) with ``_n`` lines and those that violate a
    row predicate, written; per order the promised dates' range as well.  The two keys with about as
    many values as lines are folded alone; the others share a pass of grouping sets, whose copies of a
    line end in the scan's tasks."""
    dates = [F.min("promised_date").alias("_first"), F.max("promised_date").alias("_last")]
    measures = [
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~(non_negative("units_ordered") & non_negative("units_shipped"))).alias("v_units_negative"),
        F.count_if(~holds(F.col("units_shipped") <= F.col("units_ordered"))).alias("v_over_shipped"),
        F.count_if(~holds(F.col("promised_date") >= F.col("order_date"))).alias("v_promise_before_order"),
    ]
    many, few = LINE_KEYS[:2], LINE_KEYS[2:]
    folds = {key: written_once(lines.groupBy(key).agg(*measures, *(dates if key == "order_id" else [])), "line-folds") for key in many}
    grouping = F.lit(0)
    for i in range(len(few)):
        grouping = F.when(F.col("_grouping") == (1 << len(few)) - 1 - (1 << len(few) - 1 - i), i).otherwise(grouping)
    rows = lines.groupingSets([[key] for key in few], *few).agg(F.grouping_id().alias("_grouping"), *measures)
    rows = written_once(rows.withColumn("_kind", grouping).drop("_grouping"), "line-folds", partition_by="_kind")
    return folds | {key: rows.where(F.col("_kind") == i).drop("_kind") for i, key in enumerate(few)}


def _references(keys: DataFrame, key: str, parent: DataFrame, name: str) -> tuple[list[str], DataFrame]:
    """Rows and duplicate keys of ``parent``, and keys of the lines that it does not have (a NULL is missing)."""
    own = parent.groupBy(F.col(key).alias("_pk")).agg(F.count(F.lit(1)).alias("_rows"))
    both = keys.select(F.col(key).alias("_fk"), F.lit(1).alias("_used")).join(own, F.col("_fk") == F.col("_pk"), "full")
    return _facts(both, **{f"{name}_rows": F.sum("_rows"), f"d_{name}": F.count_if(F.col("_rows") > 1),
                           f"r_{name}": F.count_if(F.col("_used").isNotNull() & F.col("_rows").isNull())})


def _orders(erp: DataFrame, shipments: DataFrame) -> tuple[list[str], DataFrame]:
    """Order/shipment coverage both ways, the promise checks and the shipments' row predicates.

    ``erp`` has one row per order id of the lines; shipments are folded likewise.  A NULL
    id matches nothing.
    """
    on_time = holds(F.lower(F.col("on_time").cast("string")) == "true") != holds(F.col("delivery_date") <= F.col("promised_date"))
    tms = shipments.groupBy(F.col("order_id").alias("_so")).agg(
        F.count(F.lit(1)).alias("_shipments"),
        F.min("promised_date").alias("_tms_first"), F.max("promised_date").alias("_tms_last"),
        F.count("promised_date").alias("_tms_known"),
        F.count_if(~holds(F.col("delivery_date") >= F.col("ship_date"))).alias("_late_ship"),
        F.count_if(on_time).alias("_flag"))
    agree = holds((F.col("_tms_first") == F.col("_first")) & (F.col("_tms_last") == F.col("_first"))
                  & (F.col("_tms_known") == F.col("_shipments")))
    erp = erp.select(F.col("order_id").alias("_lo"), "_first", "_last", F.lit(1).alias("_erp"))
    return _facts(
        erp.join(tms, F.col("_lo") == F.col("_so"), "full"),
        r_shipment_order=F.count_if(F.col("_erp").isNull()),
        r_order_shipment=F.count_if(F.col("_shipments").isNull()),
        v_promise_not_single=F.count_if(F.col("_erp").isNotNull() & ~holds(F.col("_first") == F.col("_last"))),
        v_promise_mismatch=F.count_if(F.col("_shipments").isNotNull() & ~agree),
        shipment_orders=F.count("_so"),
        d_shipment_order=F.count_if(F.col("_shipments") > 1),
        v_delivery_before_ship=F.sum("_late_ship"),
        v_on_time_flag=F.sum("_flag"),
    )


def _fmt4(x: Column) -> Column:
    return F.coalesce(F.format_string("%.4f", as_double(x)), F.lit("nan"))


def _metric(name: str) -> Column:
    return F.col(f"m_{name}")


def data_quality_report(
    customers: DataFrame,
    suppliers: DataFrame,
    products: DataFrame,
    lines: DataFrame,
    shipments: DataFrame,
    inventory: DataFrame,
    forecasts: DataFrame,
    activity: DataFrame,
    summary: DataFrame,
    detail: DataFrame,
    carriers: DataFrame,
    reconciliation: DataFrame,
    raise_on_fail: bool = False,
) -> DataFrame:
    """The 38 source-contract, KPI-invariant and evidence checks."""
    folds = line_folds(lines)
    demanded = F.col("average_daily_demand") > 0
    stock = by_date(inventory, "snapshot_date", ["warehouse", "sku"],
                    F.count_if(~(non_negative("on_hand_units") & non_negative("average_daily_demand") & non_negative("inventory_value"))).alias("_bad"),
                    F.count_if(demanded).alias("_demanded"), F.count_if(demanded & (F.col("on_hand_units") <= 0)).alias("_stockouts"))
    planned = by_date(forecasts, "month", ["warehouse", "sku"],
                      F.count_if(~(non_negative("forecast_units") & non_negative("actual_units"))).alias("_bad"))
    worked = by_date(activity, "activity_date", ["warehouse"],
                     F.count_if(~(non_negative("units_processed") & holds(F.col("labor_hours") > 0))).alias("_bad"))
    by_metric = summary.groupBy("metric").agg(F.count(F.lit(1)).alias("_n"), F.max("value").alias("_value"),
                                              F.count_if(~is_finite("value")).alias("_not_finite"))
    facts = [
        _facts(folds["order_line_id"], line_rows=F.sum("_n"), d_order_line=F.count_if(F.col("_n") > 1),
               **{v: F.sum(v) for v in ("v_units_negative", "v_over_shipped", "v_promise_before_order")}),
        _orders(folds["order_id"], shipments),
        _references(folds["customer_id"], "customer_id", customers, "customer"),
        _references(folds["sku"], "sku", products, "product"),
        _references(folds["supplier_id"], "supplier_id", suppliers, "supplier"),
        _facts(stock, d_inventory=_surplus(), v_inventory_negative=F.sum("_bad"), demanded=F.sum("_demanded"), stockouts=F.sum("_stockouts")),
        _facts(planned, d_forecast=_surplus(), v_forecast_negative=F.sum("_bad")),
        _facts(worked, d_activity=_surplus(), v_activity_invalid=F.sum("_bad")),
        _facts(by_id(detail, "order_id"), d_detail_order=_surplus(), detail_rows=F.sum("_n")),
        _facts(carriers, carrier_rows=F.count(F.lit(1))),
        _facts(reconciliation, recon_rows=F.count(F.lit(1)), recon_not_pass=F.count_if(F.col("status") != "PASS")),
    ]
    together = facts[0][1]
    for _, one in facts[1:]:
        together = together.unionAll(one)
    together = together.agg(F.map_from_entries(F.flatten(F.collect_list(F.map_entries("facts")))).alias("facts"))  # some forty numbers
    metric_row = by_metric.agg(
        *[F.max(F.when(F.col("metric") == m, F.col("_value"))).alias(f"m_{m}") for m in SUMMARY_METRICS],
        *[F.count_if(F.col("metric") == m).alias(f"n_{m}") for m in SUMMARY_METRICS],
        F.coalesce(F.sum("_n"), F.lit(0)).alias("summary_rows"),
        F.coalesce(F.sum("_not_finite"), F.lit(0)).alias("v_not_finite"),
        F.count_if(F.col("_n") > 1).alias("d_metric"),
    )
    names = [name for own, _ in facts for name in own]
    row = together.crossJoin(F.broadcast(metric_row)).select("*", *[F.col("facts")[n].alias(n) for n in names])  # one row each

    def in_unit(name: str) -> Column:
        x = _metric(name)
        return holds(is_finite(x) & (x >= 0) & (x <= 1))

    present = None
    for m in SUMMARY_METRICS:
        c = F.col(f"n_{m}") > 0
        present = c if present is None else present & c
    expected_stockout = F.when(F.col("demanded") > 0, F.col("stockouts") / F.col("demanded")).otherwise(F.lit(0.0))
    n = lambda c: F.col(c).cast("string")

    # Names, order and detail texts of the 38 checks.
    checks: list[tuple[str, Column, Column]] = [
        ("customer_key_unique", F.col("d_customer") == 0, F.concat(F.lit("rows="), n("customer_rows"))),
        ("supplier_key_unique", F.col("d_supplier") == 0, F.concat(F.lit("rows="), n("supplier_rows"))),
        ("product_key_unique", F.col("d_product") == 0, F.concat(F.lit("rows="), n("product_rows"))),
        ("order_line_key_unique", F.col("d_order_line") == 0, F.concat(F.lit("rows="), n("line_rows"))),
        ("shipment_order_unique", F.col("d_shipment_order") == 0, F.concat(F.lit("orders="), n("shipment_orders"))),
        ("shipment_orders_exist", F.col("r_shipment_order") == 0, F.lit("every shipment references an ERP order")),
        ("order_shipment_coverage", (F.col("r_shipment_order") == 0) & (F.col("r_order_shipment") == 0),
         F.lit("every modeled order has exactly one shipment")),
        ("order_customers_exist", F.col("r_customer") == 0, F.lit("every order references a customer")),
        ("order_products_exist", F.col("r_product") == 0, F.lit("every order line references a product")),
        ("order_suppliers_exist", F.col("r_supplier") == 0, F.lit("every order line references a supplier")),
        ("inventory_grain_unique", F.col("d_inventory") == 0, F.lit("grain=snapshot_date,warehouse,sku")),
        ("forecast_grain_unique", F.col("d_forecast") == 0, F.lit("grain=month,warehouse,sku")),
        ("activity_grain_unique", F.col("d_activity") == 0, F.lit("grain=activity_date,warehouse")),
        ("units_non_negative", F.col("v_units_negative") == 0, F.lit("ordered and shipped units >= 0")),
        ("shipped_not_above_ordered", F.col("v_over_shipped") == 0, F.lit("line-level shipped <= ordered")),
        ("promised_not_before_order", F.col("v_promise_before_order") == 0, F.lit("promised date >= order date")),
        ("shipment_promise_matches_erp", (F.col("v_promise_not_single") == 0) & (F.col("v_promise_mismatch") == 0),
         F.lit("one ERP promise per order and TMS promise matches it")),
        ("delivery_not_before_ship", F.col("v_delivery_before_ship") == 0, F.lit("delivery date >= ship date")),
        ("source_on_time_consistent", F.col("v_on_time_flag") == 0, F.lit("source flag matches delivery <= promise")),
        ("inventory_non_negative", F.col("v_inventory_negative") == 0, F.lit("inventory measures >= 0")),
        ("forecast_non_negative", F.col("v_forecast_negative") == 0, F.lit("forecast and actual units >= 0")),
        ("activity_valid", F.col("v_activity_invalid") == 0, F.lit("processed units >= 0 and labor hours > 0")),
        ("summary_metric_unique", F.col("d_metric") == 0, F.concat(F.lit("metrics="), n("summary_rows"))),
        ("summary_metrics_complete", present, F.lit(f"required={len(SUMMARY_METRICS)}")),
        ("summary_values_finite", F.col("v_not_finite") == 0, F.lit("all reported KPI values are finite")),
        ("order_output_unique", F.col("d_detail_order") == 0, F.concat(F.lit("orders="), n("detail_rows"))),
    ]
    for check, metric in (
        ("unit_fill_rate_range", "unit_fill_rate"),
        ("complete_order_rate_range", "complete_order_rate"),
        ("on_time_delivery_rate_range", "on_time_delivery_rate"),
        ("otif_rate_range", "otif_rate"),
        ("backorder_rate_range", "backorder_rate"),
        ("forecast_accuracy_range", "weighted_forecast_accuracy"),
        ("stockout_rate_range", "stockout_location_sku_rate"),
    ):
        checks.append((check, in_unit(metric), F.concat(F.lit("value="), _fmt4(_metric(metric)))))
    otif, fill, back = _metric("otif_rate"), _metric("unit_fill_rate"), _metric("backorder_rate")
    checks += [
        ("stockout_rate_matches_demanded_inventory",
         F.abs(_metric("stockout_location_sku_rate") - expected_stockout) < TOLERANCE,
         F.concat(F.lit("stockouts="), n("stockouts"), F.lit("; demanded_combinations="), n("demanded"))),
        ("otif_not_above_components",
         otif <= F.least(_metric("complete_order_rate"), _metric("on_time_delivery_rate")) + TOLERANCE,
         F.lit("OTIF <= in-full and on-time")),
        ("backorder_complements_fill", F.abs(fill + back - 1) < TOLERANCE,
         F.lit("fill + backorder = 1 under the documented model")),
        ("carrier_output_non_empty", F.col("carrier_rows") > 0, F.concat(F.lit("carriers="), n("carrier_rows"))),
        ("sql_python_reconciliation_passed", (F.col("recon_rows") > 0) & (F.col("recon_not_pass") == 0),
         F.concat(F.lit("metrics="), n("recon_rows"))),
    ]
    entries = F.array(*[
        F.struct(F.lit(i).alias("check_order"), F.lit(name).alias("check"), holds(ok).alias("passed"), det.alias("detail"))
        for i, (name, ok, det) in enumerate(checks, start=1)
    ])
    report = row.select(F.inline(entries)).select(
        F.col("check_order").cast(T.IntegerType()).alias("check_order"),
        "check",
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"),
        "detail",
    )
    if raise_on_fail:
        report = report.withColumn(
            "status",
            F.when(F.col("status") == "FAIL",
                   F.raise_error(F.concat(F.lit("data quality check failed: "), F.col("check")))).otherwise(F.col("status")),
        )
    return report
