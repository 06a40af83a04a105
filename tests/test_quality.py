"""Data-quality report on the adapter data and on injected defects."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cargoline.plans.model import FulfillmentModel
from cargoline.sources.adapter import from_tpch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return FulfillmentModel(from_tpch(spark, SF_DIR))


def _status(report):
    return {r.check: r.status for r in report.collect()}


def test_report_has_38_checks_with_expected_failures(model):
    status = _status(model.data_quality_report)
    assert len(status) == 38
    # the adapter data carries duplicate line ids, shipments of orders without
    # lines and open orders; the two paths disagree on open orders
    assert status["order_line_key_unique"] == "FAIL"
    assert status["shipment_orders_exist"] == "FAIL"
    assert status["order_shipment_coverage"] == "FAIL"
    assert status["sql_python_reconciliation_passed"] == "FAIL"
    for ok in ("customer_key_unique", "units_non_negative", "summary_metrics_complete", "summary_values_finite",
               "otif_not_above_components", "backorder_complements_fill", "stockout_rate_matches_demanded_inventory",
               "carrier_output_non_empty", "source_on_time_consistent", "delivery_not_before_ship"):
        assert status[ok] == "PASS", ok


def test_injected_defects_are_caught(model, spark):
    from cargoline import operators as ops

    s = model.src
    bad_inv = s.wms_inventory_snapshots.withColumn(
        "on_hand_units", F.when(F.col("sku") == 1, F.lit(None).cast("long")).otherwise(F.col("on_hand_units"))
    )
    bad_ship = s.tms_shipments.withColumn("on_time", F.when(F.col("order_id") == 1, ~F.col("on_time")).otherwise(F.col("on_time")))
    report = ops.data_quality_report(
        s.customers, s.suppliers, s.products, s.erp_order_lines, bad_ship, bad_inv,
        s.demand_forecasts, s.warehouse_activity, model.kpi_summary, model.order_service,
        model.carrier_scorecard, model.reconcile_metrics,
    )
    status = _status(report)
    assert status["inventory_non_negative"] == "FAIL"  # NULL measure fails a ">= 0" check
    assert status["source_on_time_consistent"] == "FAIL"


def test_raise_on_fail(model):
    from cargoline import operators as ops

    s = model.src
    report = ops.data_quality_report(
        s.customers, s.suppliers, s.products, s.erp_order_lines, s.tms_shipments, s.wms_inventory_snapshots,
        s.demand_forecasts, s.warehouse_activity, model.kpi_summary, model.order_service,
        model.carrier_scorecard, model.reconcile_metrics, raise_on_fail=True,
    )
    with pytest.raises(Exception, match="data quality check failed"):
        report.collect()


def test_reconciliation_flags_policy_difference(model):
    status = _status(model.reconcile_metrics.withColumnRenamed("metric", "check"))
    assert status["on_time_delivery_rate"] == "FAIL" and status["otif_rate"] == "FAIL"
    assert status["total_orders"] == "PASS" and status["total_cost_to_serve"] == "PASS"


def test_grain_check_passes(model):
    assert model.mart_grain_check.collect()[0].duplicate_orders == 0


def test_views_are_queryable_with_spark_sql(model, spark):
    from cargoline.plans.model import register_views

    register_views(model, prefix="t_")
    row = spark.sql("SELECT total_orders, otif_rate FROM t_mart_kpi_summary").collect()[0]
    assert row.total_orders == model.mart_kpi_summary.collect()[0].total_orders
    n = spark.sql("SELECT count(*) AS n FROM t_erp_order_lines").collect()[0].n
    assert n == model.src.erp_order_lines.count()


def test_uniqueness_by_bitmaps(spark):
    """Rows beyond the first of their key, for ids of any size and type and for dates, with NULLs."""
    import datetime as dt
    import random
    from collections import Counter

    from cargoline.operators.quality import _surplus, by_date, by_id

    rng = random.Random(4)
    ids = [rng.choice([None, 0, 1, 63, 64, -1, -64, -65, 2**62, -2**63, rng.randint(-300, 300)]) for _ in range(500)]
    extra = sum(n - 1 for n in Counter(ids).values())
    for kind in ("bigint", "string"):
        df = spark.createDataFrame([(None if i is None else i,) for i in ids], "k bigint").selectExpr(f"cast(k as {kind}) k")
        assert by_id(df, "k").agg(_surplus().alias("s")).first().s == extra
    small = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert by_id(small, "k").agg(_surplus().alias("s")).first().s == 0
    day = lambda: rng.choice([None, dt.date(1992, 1, 31), dt.date(1997, 5, 1), dt.date(1997, 4, 30) + dt.timedelta(rng.randint(0, 900))])
    keys = [(day(), rng.choice([None, "W1", "W2"]), rng.choice([None, 1, 2])) for _ in range(900)]
    df = spark.createDataFrame(keys, "d date, w string, k int").repartition(7)
    assert by_date(df, "d", ["w", "k"]).agg(_surplus().alias("s")).first().s == sum(n - 1 for n in Counter(keys).values())
    assert by_date(df.distinct(), "d", ["w", "k"]).agg(_surplus().alias("s")).first().s == 0


def test_line_folds_by_every_key(spark):
    from collections import Counter

    from cargoline.operators.quality import LINE_KEYS, line_folds
    from cargoline.schemas import source_schemas

    rows = [("a", "1", "C", "W", None, None, "P", None, 1, 2, None, None, None), ("a", "1", None, "W", None, None, "P", "S", None, 2, None, None, None),
            (None, None, None, None, None, None, None, None, -1, -1, None, None, None)]
    folds = line_folds(spark.createDataFrame(rows, source_schemas()["erp_order_lines"]))
    at = dict(zip(source_schemas()["erp_order_lines"].names, zip(*rows)))
    for key in LINE_KEYS:
        got = folds[key].collect()
        assert {r[key]: r._n for r in got} == dict(Counter(at[key])) and sum(r.v_units_negative for r in got) == 2, key
        assert sum(r.v_over_shipped for r in got) == 2 and sum(r.v_promise_before_order for r in got) == 3
    assert all(f.count() == 0 for f in line_folds(spark.createDataFrame([], source_schemas()["erp_order_lines"])).values())


def test_report_scans_every_source_once(spark, tmp_path):
    """Over written sources, the report's own plan reads each table at most once, and the lines not at all (their folds)."""
    import re

    from cargoline import operators as ops
    from cargoline.sources.readers import SOURCE_FILES, read_parquet_sources, write_parquet_sources

    write_parquet_sources(from_tpch(spark, SF_DIR), str(tmp_path))
    src = read_parquet_sources(spark, str(tmp_path))
    model = FulfillmentModel(src)
    out = {name: getattr(model, name) for name in ("kpi_summary", "order_service", "carrier_scorecard", "reconcile_metrics")}
    for name, df in out.items():
        df.write.parquet(str(tmp_path / name))
        out[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in the plan
    report = ops.data_quality_report(src.customers, src.suppliers, src.products, src.erp_order_lines, src.tms_shipments, src.wms_inventory_snapshots,
                                     src.demand_forecasts, src.warehouse_activity, *out.values())
    assert len(report.collect()) == 38
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for name in [*SOURCE_FILES, *out]:
        assert len(re.findall(rf"FileScan parquet [^\n]*/{name}[\],]", plan)) == (name != "erp_order_lines"), name
    assert plan.count("BroadcastNestedLoopJoin") <= 1
    shuffles = len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|SinglePartition)", plan))
    assert shuffles <= 31, shuffles  # 62 with a plan of its own for every check


def test_report_writes_only_what_it_reads_several_times(spark, monkeypatch):
    """The mart is read once, for its KPIs, and not written; ids with as many values as lines are not copied for every key."""
    from cargoline.operators import quality
    from cargoline.plans.materialize import WrittenModel, WrittenTpchSources

    folds, real = [], quality.written_once
    monkeypatch.setattr(quality, "written_once", lambda df, *a, **o: (folds.append(df), real(df, *a, **o))[1])
    model = WrittenModel(WrittenTpchSources(spark, SF_DIR))
    assert model.data_quality_report.count() == 38
    assert "mart_order_service" not in model.__dict__
    copied = [df for df in folds if "Expand" in df._jdf.queryExecution().optimizedPlan().toString()]
    assert len(copied) == 1 and not {"order_line_id", "order_id"} & set(copied[0].columns)
    written = WrittenModel(WrittenTpchSources(spark, SF_DIR))
    assert written.mart_order_service.count() and written.reported_mart_summary.collect() == model.reported_mart_summary.collect()
