"""Source tables: readers for extracts and the adapter over the driver's tables."""
from cargoline.sources.adapter import from_tpch  # noqa: F401
from cargoline.sources.csv_extracts import CsvSources, csv_view, read_csv_sources  # noqa: F401
from cargoline.sources.readers import (  # noqa: F401
    Sources,
    read_parquet_sources,
    write_parquet_sources,
)
