"""The batch refresh writes every output; the streaming trigger runs it."""
from __future__ import annotations

import os
import tempfile

import pytest

from cargoline.plans.materialize import materialize_sources
from cargoline.plans.refresh import OUTPUTS, run_refresh
from cargoline.sources.adapter import from_tpch
from cargoline.sources.readers import write_parquet_sources

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def extracts(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    folder = tempfile.mkdtemp(prefix="cargoline-extracts-")
    write_parquet_sources(from_tpch(spark, SF_DIR), folder)
    return folder


def test_refresh_writes_every_output(spark, extracts):
    from cargoline.sources.readers import read_parquet_sources

    out = tempfile.mkdtemp(prefix="cargoline-out-")
    written = run_refresh(spark, read_parquet_sources(spark, extracts), out, csv=True)
    assert set(written) == set(OUTPUTS)
    assert spark.read.parquet(written["data_quality_report"]).count() == 38
    assert spark.read.parquet(written["kpi_summary"]).count() == 11
    assert os.path.isdir(written["kpi_summary"] + "_csv")
    with pytest.raises(RuntimeError, match="validation failed"):
        run_refresh(spark, read_parquet_sources(spark, extracts), tempfile.mkdtemp(), raise_on_fail=True)


def test_streaming_trigger_runs_refresh(spark, extracts):
    from cargoline.streaming import refresh_on_arrival

    out = tempfile.mkdtemp(prefix="cargoline-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="cargoline-stream-ckpt-")
    q = refresh_on_arrival(spark, extracts, out, ckpt)
    q.awaitTermination(600)
    assert q.exception() is None
    batches = [d for d in os.listdir(out) if d.startswith("batch=")]
    assert batches
    assert spark.read.parquet(os.path.join(out, batches[0], "kpi_summary")).count() == 11


def test_materialized_sources_round_trip(spark):
    src = from_tpch(spark, SF_DIR)
    written = materialize_sources(spark, src)
    assert written.erp_order_lines.columns == src.erp_order_lines.columns
    assert written.erp_order_lines.count() == src.erp_order_lines.count()


def test_csv_extracts_round_trip(spark):
    """CSV extracts with a header, read with explicit schemas, give the same KPIs."""
    from pyspark.sql import types as T

    from cargoline.plans.model import FulfillmentModel
    from cargoline.sources import read_csv_sources
    from cargoline.sources.readers import SOURCE_FILES

    src = from_tpch(spark, SF_DIR)
    folder = tempfile.mkdtemp(prefix="cargoline-csv-")
    for name, stem in SOURCE_FILES.items():
        getattr(src, name).write.option("header", True).csv(os.path.join(folder, f"{stem}.csv"))
    csv_src = read_csv_sources(spark, folder, T.LongType())
    assert csv_src.tms_shipments.schema["on_time"].dataType == T.BooleanType()
    assert csv_src.erp_order_lines.schema["order_date"].dataType == T.DateType()
    direct = sorted(FulfillmentModel(src).kpi_summary.collect())
    via_csv = sorted(FulfillmentModel(csv_src).kpi_summary.collect())
    assert [r.metric for r in direct] == [r.metric for r in via_csv]
    assert [r.value for r in direct] == pytest.approx([r.value for r in via_csv], rel=1e-12)  # sums of doubles in any order
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_csv_sources(spark, os.path.join(folder, "missing")).customers.count()
