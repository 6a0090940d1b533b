"""Typed readers for the six base tables.

CSV columns are found by the names in each file's header and read as text (no inference; quotes inside a
quoted value are doubled, and it may hold line breaks), stripped of white space, and a blank becomes NULL.  Text that cannot be cast and
lines of the wrong shape are never lost without a word: reading stops at them, or
``split_bad_rows`` returns them with what failed.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendero.schemas import SCHEMAS, TABLE_NAMES, Tables

CORRUPT = "_corrupt_record"
FAILED = "_failed_columns"


#: What a value is stripped of.
BLANKS = " \t\n\r\v\f\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BYTE_ORDER_MARK = "\ufeff"


def _text(column: str, first: bool = False) -> Column:
    # Only the first column of a file can carry its byte-order mark.
    blanks = BLANKS + BYTE_ORDER_MARK if first else BLANKS
    return F.nullif(F.trim(F.col(column), F.lit(blanks)), F.lit(""))


def _typed(field: T.StructField, first: bool = False) -> Column:
    text = _text(field.name, first)
    if isinstance(field.dataType, T.BooleanType):
        return F.coalesce(F.lower(text) == "true", F.lit(False))
    if isinstance(field.dataType, T.DateType):
        return F.coalesce(text.try_cast("date"), F.try_to_timestamp(text).cast("date"))
    return text.try_cast(field.dataType)


def _checked(field: T.StructField, first: bool) -> Column:
    """The typed value; the job stops at text that has none."""
    text, typed = _text(field.name, first), _typed(field, first)
    if isinstance(field.dataType, (T.StringType, T.BooleanType)):
        return typed
    message = F.concat(F.lit(f"{field.name} is not of type {field.dataType.simpleString()}: "), text)
    return F.when(text.isNotNull() & typed.isNull(), F.raise_error(message)).otherwise(typed)


def survey_csv(spark: SparkSession, path: str, line_breaks: bool | None = None) -> DataFrame:
    """Per file: ``header``, and ``spans``: whether a value holds a line break (a line with an odd number of
    quotes).  One pass over the text, of which a row for each file and task moves; with ``line_breaks`` given,
    only the first block of each file is looked at."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),  # within a block, lines come in their order
    )
    if line_breaks is not None:
        lines = lines.filter("block = 0")
    first = F.when(F.col("block") == 0, F.struct("nth", "value"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    spans = F.bool_or(odd) if line_breaks is None else F.bool_or(F.lit(line_breaks))
    return lines.groupBy("file").agg(F.min(first)["value"].alias("header"), spans.alias("spans"))


def _columns_of(header: str, file: str, schema: T.StructType) -> list[str]:
    """The file's columns in order; those the table does not have get a name of their own."""
    names = [name.strip(BLANKS + BYTE_ORDER_MARK) for name in next(csv.reader([header]))]
    missing = [f.name for f in schema if f.name not in names]
    twice = [f.name for f in schema if names.count(f.name) > 1]
    if missing or twice:
        problem = f"lacks {', '.join(missing)}" if missing else f"has {', '.join(twice)} more than once"
        raise ValueError(f"{file} {problem}; its header is {header!r}")
    wanted = {f.name for f in schema}
    return [name if name in wanted else f"_extra_{k}" for k, name in enumerate(names)]


def _raw_csv(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE", line_breaks: bool | None = None
) -> DataFrame:
    """The text of the table's columns, whatever their order in each file.  Files with the same header are
    read together.  A file in which a value holds a line break is parsed whole, by one task; all others are split."""
    alike: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in survey_csv(spark, path, line_breaks).collect():  # a row for each file, which the driver lists anyway
        kind = tuple(_columns_of(row.header, unquote(row.file), schema)), row.spans
        alike.setdefault(kind, []).append(unquote(row.file))
    corrupt = [CORRUPT] if mode == "PERMISSIVE" else []
    if not alike:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*schema.names, *corrupt]]))
    frames = [
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *corrupt]]))
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", spans)
        # A line of the wrong shape is only seen when no column is pruned from the parse.
        .option("columnPruning", False)
        .csv(files)
        .select(*schema.names, *corrupt)
        for (columns, spans), files in alike.items()
    ]
    return reduce(DataFrame.unionAll, frames)


def read_csv_table(spark: SparkSession, path: str, table: str, line_breaks: bool | None = None) -> DataFrame:
    """Typed scan of one base table.  Columns are found by name in the header of each file; others are left
    out, and a file that lacks one is refused.  A line of the wrong shape or text that does not cast
    stops the job; ``split_bad_rows`` reads such files.  Where it is known whether values hold line breaks,
    ``line_breaks`` saves a pass over the text."""
    schema = SCHEMAS[table]
    raw = _raw_csv(spark, path, schema, "FAILFAST", line_breaks)
    return raw.select(*[_checked(f, k == 0).alias(f.name) for k, f in enumerate(schema)])


def split_bad_rows(
    spark: SparkSession, path: str, table: str, line_breaks: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: bad rows keep their raw text, the malformed record if the line had the
    wrong shape, and the names of the columns whose text did not cast."""
    schema = SCHEMAS[table]
    failures = [
        F.when(_text(f.name, k == 0).isNotNull() & _typed(f, k == 0).isNull(), F.lit(f.name))
        for k, f in enumerate(schema)
        if not isinstance(f.dataType, (T.StringType, T.BooleanType))
    ]
    failed = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    marked = _raw_csv(spark, path, schema, line_breaks=line_breaks).withColumn(FAILED, failed)
    is_bad = F.col(CORRUPT).isNotNull() | (F.size(FAILED) > 0)
    good = marked.filter(~is_bad).select(*[_typed(f, k == 0).alias(f.name) for k, f in enumerate(schema)])
    return good, marked.filter(is_bad)


def load_table(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return read_csv_table(spark, path, table)
    return spark.read.schema(SCHEMAS[table]).format(fmt).load(path)


def load_tables(spark: SparkSession, directory: str, fmt: str = "csv") -> Tables:
    """All six tables from ``<directory>/<table>.csv`` (or ``<directory>/<table>`` for columnar
    formats, where a folder of part files is usual)."""
    suffix = ".csv" if fmt == "csv" else ""
    return {t: load_table(spark, f"{directory}/{t}{suffix}", t, fmt) for t in TABLE_NAMES}
