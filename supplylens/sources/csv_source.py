"""Typed scans of the six CSV extracts.

Columns are matched by header name. NULL tokens become NULL; any other text that does
not fit its column's type is an error, never a silent NULL. A record with more fields than
the header, or a quote that is not closed, is an error too; missing fields at the end of a
record are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import null_tokens_to_null
from ..operators.quality import DataQualityError
from .files import exists
from .quoted_lines import quoted_records
from .schemas import SOURCE_COLUMNS, SOURCE_TABLES

DATE_PATTERN = "yyyy-M-d"
_ODD_RECORD = "_record_of_other_length"


def csv_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.csv"


def require_sources(spark: SparkSession, folder: str) -> None:
    """Fail with the full list of extracts that are not there."""
    missing = [f"{t}.csv" for t in SOURCE_TABLES if not exists(spark, csv_path(folder, t))]
    if missing:
        raise FileNotFoundError(f"missing required CSV files in {folder}: {missing}")


def field_count(record: Column) -> Column:
    """Fields of a record: the commas outside its quotes and one."""
    outside = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def read_text_columns(
    spark: SparkSession, folder: str, table: str, multi_line: bool = False
) -> DataFrame:
    """All columns of an extract as text, under their header names, NULL tokens removed.

    ``multi_line`` allows line breaks inside quotes; the file is split all the same. A record with more
    fields than the header, wherever the surplus ones stand, fails when the rows are read.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    path = csv_path(folder, table)
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in SOURCE_COLUMNS[table] if c not in header]
    if missing:
        raise DataQualityError(f"{path} lacks columns {missing}")
    # the parser gives the text of a record whose fields are not as many as the header's
    schema = ", ".join(f"`{c}` string" for c in [*header, _ODD_RECORD])
    lenient = {"columnNameOfCorruptRecord": _ODD_RECORD, "mode": "PERMISSIVE"}
    if multi_line:
        parsed = F.from_csv("record", schema, {"quote": '"', "escape": '"', **lenient})
        raw = quoted_records(spark, path).select(parsed.alias("r")).select("r.*")
    else:
        raw = spark.read.options(**options, **lenient, enforceSchema=True).schema(schema).csv(path)
    problem = F.concat(F.lit(f"more fields than the header has in {table}.csv: "), F.substring(_ODD_RECORD, 1, 200))
    surplus = F.coalesce(field_count(F.col(_ODD_RECORD)) > len(header), F.lit(False))
    checked = raw.where(F.when(surplus, F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*[null_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in header])


def require_closed_quotes(spark: SparkSession, folder: str, table: str) -> None:
    """Fail if a line's quotes do not pair up by itself, which would run two records into one."""
    path = csv_path(folder, table)
    lines = spark.read.text(path).select("value", F.regexp_count("value", F.lit('"')).alias("n"))
    found = [r[0][:200] for r in lines.where(F.col("n") % 2 == 1).limit(3).collect()]
    if found:
        raise DataQualityError(f"{path} has lines with an open quote (a line break in a field needs multi_line): {found}")


def parsed_date(c: Column) -> Column:
    """Lenient date: text that is no date is NULL."""
    return F.try_to_date(c, DATE_PATTERN)


def _parsed(c: Column, kind: str) -> Column:
    if kind == "date":
        return parsed_date(c)
    value = F.trim(c).try_cast(kind)
    if kind == "bigint":  # a whole number may be written with a decimal point
        wide = F.trim(c).try_cast("decimal(38,10)")
        value = F.coalesce(value, F.when(wide == F.floor(wide), wide.try_cast("bigint")))
    return value


def strict(c: Column, kind: str, label: str) -> Column:
    """Cast that raises on text which is not NULL and does not parse."""
    if kind == "string":
        return c
    value = _parsed(c, kind)
    problem = F.concat(F.lit(f"invalid {kind} in {label}: "), c)
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(problem).cast(kind)).otherwise(value)


def parse_columns(text: DataFrame, table: str) -> DataFrame:
    """Cast the listed columns strictly; columns that are not listed stay text."""
    kinds = SOURCE_COLUMNS[table]
    return text.select(
        *[strict(F.col(f"`{c}`"), kinds.get(c, "string"), f"{table}.{c}").alias(c) for c in text.columns]
    )


def invalid_examples(text: DataFrame, table: str, n: int = 3) -> dict[str, list[str]]:
    """Up to ``n`` offending values per column; runs only to explain a failure."""
    found = {}
    for c, kind in SOURCE_COLUMNS[table].items():
        if kind == "string":
            continue
        bad = text.where(F.col(c).isNotNull() & _parsed(F.col(c), kind).isNull()).select(c).limit(n)
        values = [r[0] for r in bad.collect()]
        if values:
            found[c] = values
    return found


def read_source(
    spark: SparkSession, folder: str, table: str, multi_line: bool = False
) -> DataFrame:
    """Typed scan of one extract."""
    return parse_columns(read_text_columns(spark, folder, table, multi_line), table)


class CsvSources:
    """Source tables straight from a folder of CSV extracts."""

    def __init__(self, spark: SparkSession, folder: str, multi_line: bool = False):
        require_sources(spark, folder)
        self._spark, self._folder, self._multi_line = spark, folder, multi_line

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = read_source(self._spark, self._folder, name, self._multi_line)
        return frame.select(*columns) if columns else frame
