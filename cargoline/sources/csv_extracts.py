"""CSV extracts bound by header name, with a quarantine for records that do not parse.

The header of an extract says where each column stands; order and additional columns do not
matter, a missing or repeated column raises with its name.  Every other file of a folder
must have the same header (Spark checks each file as it reads it).  Records are read as text
and converted by expressions, so one rule decides whatever columns a query reads: a record
is good if it has as many fields as the header and every value parses to its column's
type.  The others leave the table and are kept, with their text and what is wrong, in
``CsvSources.rejected``; ``CsvSources.extract_report`` counts them.
"""
from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.schemas import source_schemas
from cargoline.sources.readers import SOURCE_FILES, Sources

#: the text of a record whose number of fields is wrong
_RECORD = "_malformed_record"
FIELD_COUNT = "field count"
#: a quote inside a quoted field is doubled, as spreadsheets and dataframe libraries write it
CSV_FORMAT = {"quote": '"', "escape": '"'}

_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of an extract as written in its header, in file order."""
    first = spark.read.options(**CSV_FORMAT).option("header", False).csv(path).head()
    return [value or "" for value in first] if first else []


def _positions(path: str, header: Sequence[str], wanted: Sequence[str]) -> dict[str, str]:
    """Wanted column -> name in the header (which may have blanks around it)."""
    names = [h.strip() for h in header]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"{path}: the header repeats column(s) {', '.join(repeated)}")
    missing = [w for w in wanted if w not in names]
    if missing:
        raise ValueError(f"{path}: missing column(s) {', '.join(missing)}; the header has {', '.join(names) or 'no columns'}")
    return {w: header[names.index(w)] for w in wanted}


def parsed(text: Column, kind: T.DataType) -> Column:
    """``text`` as ``kind``; NULL where it does not parse.

    Dates are yyyy-MM-dd with an optional time, whole numbers may have a zero fraction
    (``12.0``), decimals are rounded to their scale.
    """
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(_DATE), text.try_cast(kind))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # plain digits are most numbers; the cast trims DEL as well, a decimal does not
        number = text.try_cast(T.DecimalType(38, 6))
        plain = F.when(~text.contains("\x7f"), text.try_cast(kind))
        return F.coalesce(plain, F.when(number == F.floor(number), number.try_cast(kind)))
    return text.try_cast(kind)


@dataclass(frozen=True)
class Extract:
    """One extract: ``checked`` has the typed columns, ``_bad``, ``_problems`` and ``_text``.

    ``problems`` has a condition for each problem, by the columns of ``raw``: what only counts
    or only keeps good records needs no array of names for every record.
    """

    name: str
    schema: T.StructType
    checked: DataFrame
    raw: DataFrame
    problems: dict[str, Column]

    @property
    def good(self) -> DataFrame:
        return self.checked.where(~F.col("_bad")).select(*self.schema.names)

    @property
    def strict(self) -> DataFrame:
        """All rows; one that does not parse raises when it is read."""
        message = F.concat(F.lit(f"{self.name}: bad record ("), F.array_join("_problems", ", "), F.lit("): "), F.col("_text"))
        return self.checked.where(F.when(~F.col("_bad"), True).otherwise(F.raise_error(message).isNull())).select(*self.schema.names)

    @property
    def rejected(self) -> DataFrame:
        return self.checked.where("_bad").select(
            F.lit(self.name).alias("source"), F.col("_file").alias("file"), F.col("_problems").alias("problems"), F.col("_text").alias("record"))

    @property
    def report(self) -> DataFrame:
        """One row: source, rows_read, rows_rejected and rows by problem."""
        flags = self.raw.select(*[found.alias(f"_{i}") for i, found in enumerate(self.problems.values())])
        names = flags.columns
        row = flags.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(_any([F.col(c) for c in names])).alias("rows_rejected"),
                        *[F.count_if(F.col(c)).alias(c) for c in names])
        by_problem = F.create_map(*[x for i, p in enumerate(self.problems) for x in (F.lit(p), F.col(f"_{i}"))])
        return row.select(F.lit(self.name).alias("source"), "rows_read", "rows_rejected",
                          F.map_filter(by_problem, lambda _, n: n > 0).alias("problems"))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def read_extract(spark: SparkSession, path: str, name: str, schema: T.StructType, null_values: Sequence[str] = ()) -> Extract:
    """The extract at ``path`` (a file or a folder of files) with the columns of ``schema``.

    Empty fields are NULL, and so are the texts in ``null_values`` and blank fields of
    columns that are no text.
    """
    header = read_header(spark, path)
    at = _positions(path, header, schema.names)
    text_schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _RECORD]])
    raw = (spark.read.schema(text_schema).options(**CSV_FORMAT).option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).csv(path))

    columns, problems = [], {}
    for field in schema.fields:
        text = _quoted(at[field.name])
        if null_values:
            text = F.when(~text.isin(list(null_values)), text)
        value = parsed(text, field.dataType)
        columns.append(value.alias(field.name))
        problems[field.name] = value.isNull() & text.isNotNull()
        if not isinstance(field.dataType, T.StringType):
            problems[field.name] &= F.trim(text) != ""
    problems[FIELD_COUNT] = _quoted(_RECORD).isNotNull()
    bad = _any(list(problems.values()))
    names = F.array_compact(F.array(*[F.when(found, F.lit(problem)) for problem, found in problems.items()]))
    text = F.coalesce(_quoted(_RECORD), F.to_json(F.struct(*[_quoted(h) for h in header])))
    checked = raw.select(*columns, bad.alias("_bad"), names.alias("_problems"), text.alias("_text"), F.col("_metadata.file_path").alias("_file"))
    return Extract(name, schema, checked, raw, problems)


class CsvSources(Sources):
    """The eight sources over CSV extracts, beside what was rejected on the way."""

    def __init__(self, extracts: dict[str, Extract], strict: bool = False):
        self.extracts = extracts
        super().__init__(**{name: e.strict if strict else e.good for name, e in extracts.items()})

    @property
    def rejected(self) -> DataFrame:
        """source, file, problems and the text of every rejected record."""
        return self._all("rejected")

    @property
    def extract_report(self) -> DataFrame:
        """One row a source: rows_read, rows_rejected and rejected rows by problem (a column name or ``field count``)."""
        return self._all("report")

    def _all(self, part: str) -> DataFrame:
        out = None
        for extract in self.extracts.values():
            rows = getattr(extract, part)
            out = rows if out is None else out.unionByName(rows)
        return out


def read_csv_sources(spark: SparkSession, folder: str, id_type: T.DataType = T.StringType(),
                     on_bad: str = "quarantine", null_values: Sequence[str] = ()) -> CsvSources:
    """The eight extracts of ``folder``, columns by header name, types by schema (no inference pass).

    ``on_bad="quarantine"`` keeps records that do not parse out of the tables and counts them in
    ``extract_report``; ``"fail"`` raises when one is read.  A missing file raises Spark's
    PATH_NOT_FOUND, a missing column a ValueError with its name.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    schemas = source_schemas(id_type)
    return CsvSources({name: read_extract(spark, os.path.join(folder, f"{stem}.csv"), name, schemas[name], null_values)
                       for name, stem in SOURCE_FILES.items()}, strict=on_bad == "fail")


def csv_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """Any CSV with a header as a temp view, columns by name and types inferred from its values (one more scan)."""
    df = spark.read.options(**CSV_FORMAT).option("header", True).option("inferSchema", True).option("enforceSchema", False).csv(path)
    df.createOrReplaceTempView(view)
    return df
