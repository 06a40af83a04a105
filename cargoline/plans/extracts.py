"""CSV hand-over: the sources as CSV extracts, and the model over extracts read back.

Every step of a file-based run reads the extracts of the one before.  ``write_csv_extracts``
writes them in any column order, with columns of the sender's own, compressed: the dense
inventory and forecast grids as plain text are tens of times the tables they come from.
"""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.plans.materialize import WrittenModel
from cargoline.session import new_folder, written_once
from cargoline.sources.adapter import from_tpch
from cargoline.sources.csv_extracts import CSV_FORMAT, CsvSources, read_csv_sources
from cargoline.sources.readers import SOURCE_FILES, Sources

#: (source, column) -> rows whose value is replaced by a text that does not parse, in ``dirty_extracts``
DIRT: dict[tuple[str, str], tuple[Callable[[], Column], str]] = {
    ("suppliers", "base_lead_time_days"): (lambda: F.col("supplier_id") % 7 == 0, "n/a"),
    ("erp_order_lines", "promised_date"): (lambda: F.col("order_id") % 101 == 0, "31.12.1997"),
    ("erp_order_lines", "units_ordered"): (lambda: F.col("order_id") % 103 == 0, "1,5"),
    ("tms_shipments", "on_time"): (lambda: F.col("order_id") % 97 == 0, "maybe"),
}

#: rows of one compressed file, which a single task reads (it can't be split)
FILE_ROWS = 100_000


def extract_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The sources over the driver's tables; the order lines, which four extracts come from, are joined once."""
    sources = from_tpch(spark, sf_dir)
    sources.rebase("erp_order_lines", written_once(sources.erp_order_lines, "lines"))
    return sources


def write_csv_extracts(sources: Sources, folder: str, columns: Callable[[list[str]], list[str]] = lambda c: c,
                       dirt: dict[tuple[str, str], tuple[Callable[[], Column], str]] | None = None) -> str:
    """Write the eight sources as CSV folders (gzip, its quickest level) with headers; ``columns`` orders a source's columns."""
    options = {**CSV_FORMAT, "header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": FILE_ROWS}
    for name, stem in SOURCE_FILES.items():
        df = getattr(sources, name)
        out = []
        for c in columns(df.columns):
            value = F.col(c).cast("string")
            if dirt and (name, c) in dirt:
                bad, text = dirt[name, c]
                value = F.when(bad(), text).otherwise(value)
            out.append(value.alias(c))
        df.select(F.lit("sender").alias("extract_origin"), *out).write.options(**options).csv(os.path.join(folder, f"{stem}.csv"))
    return folder


def reordered_extracts(spark: SparkSession, sf_dir: str) -> CsvSources:
    """The sources through CSV extracts whose columns stand in reverse, beside one that nobody asked for."""
    folder = write_csv_extracts(extract_sources(spark, sf_dir), new_folder(spark, "extracts"), lambda c: c[::-1])
    return read_csv_sources(spark, folder, T.LongType())


def dirty_extracts(spark: SparkSession, sf_dir: str) -> CsvSources:
    """The sources through CSV extracts with values that do not parse (``DIRT``)."""
    folder = write_csv_extracts(extract_sources(spark, sf_dir), new_folder(spark, "extracts"), dirt=DIRT)
    return read_csv_sources(spark, folder, T.LongType())


def csv_kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline KPIs over reordered extracts: those of the sources themselves."""
    return WrittenModel(reordered_extracts(spark, sf_dir)).kpi_summary


def csv_extract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and rejected by source, and what was wrong with them, over dirty extracts."""
    report = dirty_extracts(spark, sf_dir).extract_report
    text = F.transform(F.array_sort(F.map_entries("problems")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return report.select("source", "rows_read", "rows_rejected", F.array_join(text, ", ").alias("problems"))


def csv_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined order lines of dirty extracts: their id and what was wrong."""
    rejected = dirty_extracts(spark, sf_dir).extracts["erp_order_lines"].rejected
    return rejected.select(F.get_json_object("record", "$.order_line_id").alias("order_line_id"), F.array_join("problems", ", ").alias("problems"))


EXTRACT_QUERIES = {f.__name__: f for f in (csv_kpi_summary, csv_extract_report, csv_rejected_lines)}
