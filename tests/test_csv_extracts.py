"""CSV extracts: columns by header name, bad records counted and kept."""
from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.plans.extracts import write_csv_extracts
from cargoline.plans.model import FulfillmentModel
from cargoline.plans.refresh import run_refresh
from cargoline.schemas import source_schemas
from cargoline.sources import csv_view, read_csv_sources
from cargoline.sources.csv_extracts import parsed, read_extract
from cargoline.sources.readers import SOURCE_FILES

ROWS = {
    "customers": ["C1,Retail,West", "C2,Pro,East"],
    "suppliers": ["S1,One,5,Low", "S2,Two,9,High"],
    "products": ["P1,A,S1,2.50,0.25", "P2,B,S2,4.00,1.00"],
    "erp_order_lines": ["L1,O1,C1,W1,2024-01-02,2024-01-05,P1,S1,10,10,2.50,0.25,25.00", "L2,O2,C2,W2,2024-02-02,2024-02-05,P2,S2,5,4,4.00,1.00,16.00"],
    "tms_shipments": ["T1,O1,A,W1,2024-01-03,2024-01-05,2024-01-05,2.50,9.00,1.00,0.00,True", "T2,O2,B,W2,2024-02-03,2024-02-07,2024-02-05,4.00,8.00,1.00,2.00,False"],
    "wms_inventory_snapshots": ["2024-01-01,W1,P1,3,1.5,7.5000"],
    "demand_forecasts": ["2024-01-01,W1,P1,12,10"],
    "warehouse_activity": ["2024-01-01,W1,10,80.00"],
}


def write(rows=ROWS, order=lambda c: c, extra=False, **headers):
    folder = tempfile.mkdtemp(prefix="cargoline-csv-")
    for name, schema in source_schemas().items():
        columns = schema.names
        lines = [dict(zip(columns, r.split(","))) for r in rows[name]]
        at = headers.get(name, order(columns))
        with open(os.path.join(folder, f"{SOURCE_FILES[name]}.csv"), "w") as f:
            f.write(",".join(at + ["sender"] * extra) + "\n")
            for line in lines:
                f.write(",".join([line.get(c.strip(), "") for c in at] + ["x"] * extra) + "\n")
    return folder


def tables(src):
    return {name: sorted(map(tuple, df.collect()), key=repr) for name, df in src.as_dict().items()}


def test_columns_are_found_by_name(spark):
    plain = read_csv_sources(spark, write())
    want = tables(plain)
    assert want["customers"] == [("C1", "Retail", "West"), ("C2", "Pro", "East")]
    assert want["erp_order_lines"][0] == ("L1", "O1", "C1", "W1", dt.date(2024, 1, 2), dt.date(2024, 1, 5), "P1", "S1", 10, 10,
                                          Decimal("2.50"), Decimal("0.25"), Decimal("25.00"))
    for other in (write(order=lambda c: c[::-1]), write(order=sorted, extra=True), write(order=lambda c: [f" {x} " for x in sorted(c)])):
        src = read_csv_sources(spark, other)
        assert tables(src) == want and src.customers.schema == plain.customers.schema
        assert sorted(FulfillmentModel(src).kpi_summary.collect()) == sorted(FulfillmentModel(plain).kpi_summary.collect())
        assert src.rejected.count() == 0


def test_missing_and_repeated_columns_raise_with_their_names(spark):
    with pytest.raises(ValueError, match=r"customers.csv: missing column\(s\) region, customer_segment|missing column\(s\) customer_segment, region"):
        read_csv_sources(spark, write(customers=["customer_id", "Region"]))
    with pytest.raises(ValueError, match="repeats column.*customer_id"):
        read_csv_sources(spark, write(customers=["customer_id", "customer_segment", "region", "customer_id"]))
    empty = write()
    open(os.path.join(empty, "products.csv"), "w").close()
    with pytest.raises(ValueError, match="products.csv: missing column"):
        read_csv_sources(spark, empty)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_csv_sources(spark, os.path.join(empty, "nowhere"))


def test_files_of_one_folder_must_agree(spark):
    """A part file with another order would be read by position: Spark refuses it."""
    folder = tempfile.mkdtemp(prefix="cargoline-csv-parts-")
    for i, text in enumerate(("customer_id,customer_segment,region\nC1,Retail,West\n", "region,customer_id,customer_segment\nEast,C2,Pro\n")):
        with open(os.path.join(folder, f"part-{i}.csv"), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, folder, "customers", source_schemas()["customers"]).good.collect()


BAD = {**ROWS, "suppliers": ROWS["suppliers"] + ["S3,Three,soon,Low", "S4,Four,7.0,Low", "S5,Five,7.5,Low", "S6,Six, ,Low", "S7,Seven,99999999999,Low"],
       "tms_shipments": ROWS["tms_shipments"] + ["T3,O3,B,W2,03.02.2024,2024-02-31,2024-02-05,heavy,8.00,1.00,2.00,perhaps", "T4,O4,B,W2,2024-02-03 00:00:00,2024-02-07T10:00:00,,4.005,8.00,1.00,2.00,1"]}


def test_bad_records_are_counted_and_kept(spark):
    src = read_csv_sources(spark, write(BAD, order=lambda c: c[::-1]))
    assert sorted((r.supplier_id, r.base_lead_time_days) for r in src.suppliers.collect()) == [("S1", 5), ("S2", 9), ("S4", 7), ("S6", None)]
    kept = {r.shipment_id: r for r in src.tms_shipments.collect()}
    assert set(kept) == {"T1", "T2", "T4"} and kept["T4"].ship_date == dt.date(2024, 2, 3) and kept["T4"].promised_date is None and kept["T4"].on_time
    report = {r.source: (r.rows_read, r.rows_rejected, r.problems) for r in src.extract_report.collect()}
    assert report["suppliers"] == (7, 3, {"base_lead_time_days": 3}) and report["customers"] == (2, 0, {})
    assert report["tms_shipments"] == (4, 1, {"ship_date": 1, "delivery_date": 1, "shipment_weight_kg": 1, "on_time": 1})
    rejected = {(r.source, tuple(r.problems)): r for r in src.rejected.collect()}
    assert len(rejected) == 2 and ("suppliers", ("base_lead_time_days",)) in rejected
    row = rejected["tms_shipments", ("ship_date", "delivery_date", "shipment_weight_kg", "on_time")]
    assert '"shipment_id":"T3"' in row.record and row.file.endswith("tms_shipments.csv")


def test_a_record_is_judged_whatever_columns_are_read(spark):
    src = read_csv_sources(spark, write(BAD))
    assert src.suppliers.count() == 4 and src.suppliers.select("supplier_id").count() == 4
    assert sorted(r[0] for r in src.suppliers.select("supplier_name").collect()) == ["Four", "One", "Six", "Two"]


def test_records_with_too_few_or_too_many_fields(spark):
    folder = write()
    path = os.path.join(folder, "customers.csv")
    with open(path, "a") as f:
        f.write('C3,Retail\nC4,Retail,West,more\n"C,5","say ""hi""",North\n,,\n')
    extract = read_extract(spark, path, "customers", source_schemas()["customers"])
    assert sorted(map(tuple, extract.good.collect()), key=repr) == [("C,5", 'say "hi"', "North"), ("C1", "Retail", "West"), ("C2", "Pro", "East"), (None, None, None)]
    assert sorted((r.problems, r.record) for r in extract.rejected.collect()) == [(["field count"], "C3,Retail"), (["field count"], "C4,Retail,West,more")]
    assert extract.report.first().problems == {"field count": 2}


def test_strict_reading_raises_with_the_record(spark):
    src = read_csv_sources(spark, write(BAD), on_bad="fail")
    assert src.customers.count() == 2
    with pytest.raises(Exception, match="suppliers: bad record .base_lead_time_days"):
        src.suppliers.collect()
    with pytest.raises(ValueError):
        read_csv_sources(spark, write(), on_bad="ignore")


def test_null_values_and_id_types(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)), T.StructField("note", T.StringType())])
    folder = tempfile.mkdtemp(prefix="cargoline-csv-null-")
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("note,amount,id\nNA,NaN,1\nfree,,2\nNaN, 3.10 ,x\n")
    plain = read_extract(spark, folder, "a", schema)
    assert sorted(map(tuple, plain.good.collect())) == [(2, None, "free")] and plain.report.first().problems == {"id": 1, "amount": 1}
    nulls = read_extract(spark, folder, "a", schema, null_values=("NA", "NaN"))
    assert sorted(map(tuple, nulls.good.collect())) == [(1, None, None), (2, None, "free")]


def test_views_and_auto_typed_view(spark):
    folder = write(order=lambda c: c[::-1])
    read_csv_sources(spark, folder).register("x_")
    assert spark.sql("select sum(units_shipped) from x_erp_order_lines where order_date >= date'2024-02-01'").first()[0] == 4
    df = csv_view(spark, os.path.join(folder, "erp_order_lines.csv"), "auto_lines")
    assert dict(df.dtypes)["units_ordered"] == "int" and dict(df.dtypes)["order_date"] == "date"
    assert spark.sql("select sum(units_ordered) from auto_lines").first()[0] == 15


def test_refresh_over_extracts_writes_the_report(spark):
    out = tempfile.mkdtemp(prefix="cargoline-csv-out-")
    written = run_refresh(spark, read_csv_sources(spark, write(BAD)), out)
    assert spark.read.parquet(written["rejected"]).count() == 4 and spark.read.parquet(written["extract_report"]).count() == 8
    assert spark.read.parquet(written["data_quality_report"]).count() == 38


def test_written_extracts_are_compressed_and_read_back(spark):
    """As plain text the dense grids are many times the tables they come from."""
    plain = read_csv_sources(spark, write())
    folder = write_csv_extracts(plain, os.path.join(tempfile.mkdtemp(prefix="cargoline-csv-"), "out"), lambda c: c[::-1])
    parts = [f for _, _, files in os.walk(folder) for f in files if f.startswith("part-")]
    assert len(parts) >= 8 and all(f.endswith(".csv.gz") for f in parts)
    back = read_csv_sources(spark, folder)
    assert tables(back) == tables(plain) and back.rejected.count() == 0


def test_extract_queries_join_the_order_lines_once(spark, monkeypatch):
    from cargoline.plans import extracts
    from cargoline.sources import adapter

    made = []
    lines = adapter.erp_order_lines
    monkeypatch.setattr(adapter, "erp_order_lines", lambda *a: made.append(1) or lines(*a))
    sources = extracts.extract_sources(spark, "/root/testdata/sf0.001")
    for name in ("erp_order_lines", "tms_shipments", "warehouse_activity"):
        plan = getattr(sources, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan
    assert len(made) == 1


def test_good_records_and_counts_are_compiled(spark):
    """Whole expressions of a record run uncompiled beside a lambda: only rejected records get an array of names."""
    src = read_csv_sources(spark, write(BAD))
    for name, extract in src.extracts.items():
        for df in (extract.good, extract.report):
            lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
            rows = [line for line in lines if "Aggregate" not in line]  # the report's own row has a map
            assert "lambda" not in "".join(rows) and "to_json" not in "".join(rows), name
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_whole_numbers_parse_alike_on_both_ways(spark):
    texts = ["12", "12.0", "1e3", "+5", "-0", " 7 ", "5\x7f", "\t8", "\u0663", "99999999999", "9223372036854775807", "9223372036854775808", ".5",
             "5.", "1,5", "0x1", "", " ", "--1", "7L", "1_0", "NaN", "2147483648", "-2147483648", "1.0000001", "00012"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    number = F.col("t").try_cast("decimal(38,6)")
    for kind in (T.LongType(), T.IntegerType()):
        rows = df.select("t", parsed(F.col("t"), kind).alias("got"), F.when(number == F.floor(number), number.try_cast(kind)).alias("want")).collect()
        assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]
        assert sum(r.got is not None for r in rows) > 8
