"""Plans, files and folders: what must hold at any size."""
from __future__ import annotations

import glob
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from cargoline import operators as ops
from cargoline.plans import registry
from cargoline.session import checkpoint_dir

SF_DIR = "/root/testdata/sf0.001"


def test_outputs_with_several_reads_scan_the_line_items_once(spark):
    """Over the raw tables, a shared frame is written once: no plan left reads lineitem."""
    for name in sorted(registry.SEVERAL_READS):
        df = registry.queries()[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan, name


def test_partitioned_write_has_few_files(spark):
    from cargoline.sources.adapter import from_tpch
    from cargoline.sources.readers import by_month

    lines = from_tpch(spark, "/root/testdata/sf0.01").erp_order_lines
    path = tempfile.mkdtemp(prefix="cargoline-by-month-")
    by_month(lines.repartition(40)).write.mode("overwrite").partitionBy("order_month").parquet(path)
    months = len(glob.glob(f"{path}/order_month=*"))
    files = len(glob.glob(f"{path}/order_month=*/*.parquet"))
    assert months > 50 and files <= 2 * months  # 40 writers without a rebalance: up to 40 files a month


def test_percentile_with_thousands_of_sketches_and_ties(spark):
    """Merged sketches and a group that is almost one value; every path gives the exact value."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "tie").when(F.col("id") % 3 == 1, "spread").otherwise("steps").alias("k"),
        F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 999 == 0, F.col("id").cast("double")).otherwise(5.0))
        .when(F.col("id") % 3 == 1, F.sin(F.col("id").cast("double")) * 1000)
        .otherwise((F.col("id") % 17).cast("double")).alias("v"),
    ).repartition(2000)
    for p in (0.1, 0.5, 0.9, 0.999):
        exact = {r.k: r.q for r in ops.percentile_cont(df, ["k"], "v", p, "q", accuracy=200).collect()}
        builtin = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", p).alias("q")).collect()}
        assert exact == pytest.approx(builtin, rel=1e-12)


def test_percentile_widens_when_a_bracket_misses(spark, monkeypatch):
    """With a sketch that lies, the group is widened to all its values instead of failing."""
    from cargoline.operators import quantiles

    df = spark.range(5000).select((F.col("id") * 1.0).alias("v"))
    real = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, q, a: F.transform(real(c, q, a), lambda x: x * 0 - 7.0))
    assert ops.percentile_cont(df, [], "v", 0.9, "q", accuracy=100).collect()[0].q == pytest.approx(4499.1)


def test_checkpoint_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    Context.master = "local-cluster[3,2,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_no_single_task_window_over_orders(spark):
    """Windows without a partition key run over grouped rows only."""
    from cargoline.plans.model import FulfillmentModel
    from cargoline.sources.adapter import from_tpch

    model = FulfillmentModel(from_tpch(spark, SF_DIR))
    for name in ("exception_queue", "late_full_queue", "order_service"):
        plan = getattr(model, name)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Window \[|SinglePartition", plan), name


def test_percentile_moves_counts_not_rows(spark):
    """One group with all rows: the scan's tasks count, and only counts are exchanged."""
    from cargoline.operators.quantiles import SUB_BRACKETS, bracket_counts

    v = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") % 1000 * 1.5).alias("_v"))
    bounds = spark.createDataFrame([("hot", 1200.0, 1300.5)], "k string, _lo double, _hi double")
    counts = bracket_counts(v, bounds, ["k"], True)
    rows = counts.collect()
    assert sum(r._c for r in rows) == 200_000 and len(rows) == 2 + 68
    assert {r._part for r in rows if r._x is None} == {-1, SUB_BRACKETS}
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 1
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*HashAggregate\(keys=\[[^\n]*functions=\[partial_count", plan), plan


def test_percentile_of_one_group_with_heavy_ties(spark):
    df = spark.range(0, 50_000, 1, 16).select(
        F.lit(None).cast("string").alias("k"), F.when(F.col("id") % 10 < 8, 7.25).otherwise(F.sin(F.col("id").cast("double")) * 100).alias("v"))
    for p in (0.05, 0.5, 0.9, 0.95, 1.0):
        assert ops.percentile_cont(df, ["k"], "v", p, "q").first().q == pytest.approx(df.agg(F.percentile("v", p)).first()[0], rel=1e-12)


def test_grid_partitions_follow_its_rows(spark, monkeypatch):
    from cargoline.operators import demand

    assert [demand.grid_partitions(n, 8) for n in (0, 1, 100_001, 4_800_000, 40_000_000, 4_800_000_000)] == [1, 1, 2, 8, 20, 2400]
    monkeypatch.setattr(demand, "GRID_ROWS", 500)
    lines = spark.createDataFrame([(s, f"W{s % 3}", 2000 + s % 2, s) for s in range(60)], "sku long, warehouse string, y int, units_ordered long")
    lines = lines.withColumn("order_date", F.make_date("y", F.lit(5), F.lit(17)))
    products = spark.range(100).select(F.col("id").alias("sku"), F.lit(1).cast("decimal(18,2)").alias("unit_price"))
    grid = demand.monthly_demand_grid(demand.demand_cells(lines), products)
    rows = grid.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in rows) == 100 * 3 * 13 and len(rows) == 8 and max(r["count"] for r in rows) < 1000
    assert grid.agg(F.sum("demand")).first()[0] == sum(range(60))


def test_lines_are_read_once_for_the_grid(spark):
    from cargoline.plans.model import FulfillmentModel
    from cargoline.sources.adapter import from_tpch

    model = FulfillmentModel(from_tpch(spark, SF_DIR))
    for name in ("demand_grid", "average_daily_demand", "stockout_exceptions", "forecast_accuracy_by_category"):
        plan = getattr(model, name)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan, name  # the written cells stand for them


def test_critical_stockouts_filter_the_lines_before_they_move(spark):
    from cargoline.plans.materialize import WrittenModel, WrittenTpchSources

    df = WrittenModel(WrittenTpchSources(spark, SF_DIR)).critical_stockout_customers
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") >= 2 and len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|SinglePartition)", plan)) <= 9
