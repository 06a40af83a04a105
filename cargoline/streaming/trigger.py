"""Refresh the KPI outputs when new extract files arrive.

The reference has no streams; its KPIs are a batch refresh.  What a
scheduler would do -- re-run the refresh when new ERP order-line files land
-- is expressed with Structured Streaming: a file source over the order-line
folder (explicit schema, exactly-once bookkeeping in the stream checkpoint)
and ``foreachBatch``, whose body runs the whole batch refresh over the
current extracts into a folder per micro-batch.  Using ``availableNow`` the
query processes what has arrived and stops, so it fits a scheduled job; with
a processing-time trigger it keeps watching.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cargoline.plans.refresh import run_refresh
from cargoline.schemas import source_schemas
from cargoline.sources.readers import SOURCE_FILES, read_parquet_sources


def refresh_on_arrival(
    spark: SparkSession,
    extract_dir: str,
    out_dir: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
) -> StreamingQuery:
    """Start the watcher; each non-empty micro-batch triggers ``run_refresh``
    into ``out_dir/batch=<id>``.  ``extract_dir`` holds one parquet folder per
    source table (see ``write_parquet_sources``)."""
    from pyspark.sql import types as T

    lines_schema = source_schemas(T.LongType())["erp_order_lines"]
    probe = spark.read.parquet(os.path.join(extract_dir, SOURCE_FILES["erp_order_lines"]))
    schema = probe.schema if probe.columns else lines_schema
    arrivals = spark.readStream.schema(schema).parquet(os.path.join(extract_dir, SOURCE_FILES["erp_order_lines"]))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_refresh(spark, read_parquet_sources(spark, extract_dir), os.path.join(out_dir, f"batch={batch_id}"))

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
