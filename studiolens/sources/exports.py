"""CSV exports: strict reader, writer of the same form, line sink, extract windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studiolens.functions import clock
from studiolens.session import children

LINE_END = "\r"


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    encoding: str = "UTF-8",
    required_header: dict[str, str] | None = None,
) -> DataFrame:
    """A CR-terminated CSV export with a header row and a fixed number of fields.

    Fields are read by position. One row of another length, or one value that does not
    fit its type, fails the whole file. Empty fields become NULL; blank lines are skipped.
    Text stays as it is, numbers and times may have blanks around them. With
    ``required_header`` (field to header name) these names must stand at the places of their fields.
    """
    if required_header:
        first = spark.read.text(path, lineSep=LINE_END).first()
        found = [c.strip().strip('"') for c in (first.value if first else "").split(",")]
        places = {f.name: i for i, f in enumerate(schema)}
        missing = [n for f, n in required_header.items() if found[places[f] : places[f] + 1] != [n]]
        if missing:
            raise ValueError(f"header of {path} lacks {', '.join(missing)} in place")
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("lineSep", LINE_END)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("encoding", encoding)
        # Pruned columns would hide rows of the wrong length from the check.
        .option("columnPruning", False)
        .csv(path)
    )

    def value(field: T.StructField) -> Column:
        text = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            text = F.trim(text)
        return F.nullif(text, F.lit("")).cast(field.dataType).alias(field.name)

    return raw.select(*[value(field) for field in schema])


def write_export(
    df: DataFrame, path: str, schema: T.StructType, header: dict[str, str] | None = None
) -> None:
    """Write a table in the form :func:`read_export` takes; absent columns stay empty.

    ``header`` gives other names to columns in the header row.
    """
    _write_text(df.select(*_texts(df, schema)).withColumnsRenamed(header or {}), path)


def write_site_exports(
    df: DataFrame,
    site: Column,
    sites: list[int],
    path: str,
    schema: T.StructType,
    header: dict[str, str] | None = None,
) -> dict[int, str]:
    """An export of each of ``sites`` below ``path``, all written in one pass over ``df``; where they lie.

    Rows of another ``site`` are left out. A site without rows gets an export of its header.
    """
    spark, mark = df.sparkSession, "export_site"
    rows = df.select(*_texts(df, schema), site.cast("int").alias(mark)).where(F.col(mark).isin(sites))
    _write_text(rows.withColumnsRenamed(header or {}), path, mark)
    written = children(spark, path)
    places = {one: f"{path}/{mark}={one}" for one in sites}
    for one, place in places.items():
        if f"{mark}={one}" not in written:
            write_export(spark.createDataFrame([], df.schema), place, schema, header)
    return places


def _texts(df: DataFrame, schema: T.StructType) -> list[Column]:
    columns = []
    for field in schema:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast("string").alias(field.name))
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.col(field.name).cast("timestamp_ntz")
            columns.append(F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name))
        else:
            columns.append(F.col(field.name).cast("string").alias(field.name))
    return columns


def _write_text(rows: DataFrame, path: str, *parts: str) -> None:
    (
        rows.write.mode("overwrite")
        .partitionBy(*parts)
        .option("header", True)
        .option("lineSep", LINE_END)
        .option("escape", '"')
        # Text keeps the blanks around it.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_lines(df: DataFrame, path: str, column: str = "emailaddress") -> int:
    """One value per line; returns how many lines were written."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return df.sparkSession.read.text(path).count()


def extract_window(
    df: DataFrame, ts: str, as_of: str | dt.date, back: int = 7, fwd: int = 0
) -> DataFrame:
    """What one daily export holds: whole days ``as_of-back`` to ``as_of+fwd``."""
    return df.where(clock.whole_days(ts, as_of, -back, fwd))


# Days back and forward in the daily exports.
SALES_EXTRACT = {"back": 7, "fwd": 0}
ATTENDANCE_EXTRACT = {"back": 7, "fwd": 10}
