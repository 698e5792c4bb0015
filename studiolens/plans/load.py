"""The nightly load of one site."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens import schema
from studiolens.operators import running
from studiolens.session import remove_dir, work_dir
from studiolens.sources import exports, kept, tables, versions


@dataclass(frozen=True)
class SiteFiles:
    """The four exports of a site."""

    series: str
    customers: str
    sales: str
    attendance: str


def load_attendance(
    spark: SparkSession, path: str, incoming: DataFrame, grain: str = "day"
) -> None:
    """Replace rows by id, numbering the new ones on from what stays in the table.

    Right when loads move forward in time, as each daily export does. A row without a
    customer is refused, and with it the export. The batch is parsed once, before anything changes.
    Ids are looked up by the ranges, and numbers go on from the counters that are kept with the
    table, so such a load reads the days it touches and those after them (``sources.kept``).
    """
    tables.recover(spark, path)
    folder = work_dir(spark, "attendance")
    missing = F.raise_error(F.lit("attendance without a customer")).cast("bigint")
    incoming.withColumn("custid", F.coalesce("custid", missing)).write.parquet(folder)
    incoming = spark.read.schema(incoming.schema).parquet(folder)
    stored = tables.stored_rows(spark, path)
    dated = incoming.withColumn(tables.PART, tables.part_of(F.col("classdate"), grain))
    near = kept.near_parts(spark, path, stored, dated, "id")
    if stored is not None:
        touched = tables.touched_parts(stored, dated, ["id"], "classdate", near)
        ids = incoming.select("id").distinct()
        stored = kept.counts_without(
            spark, path, stored, touched, ids, "custid", ["num", "totnum"]
        )
    counted = running.with_both_numbers(incoming, stored)
    tables.upsert_at(spark, path, counted, ["id"], "classdate", grain=grain, near=near)
    remove_dir(spark, folder)


def ingest(
    spark: SparkSession, site: str, files: SiteFiles, store: str, grain: str = "day"
) -> None:
    """Run the four loads of one site into its partition of each table.

    Tables lie at ``store/<table>/site=<site>``, so reading ``store/<table>`` gives all
    sites with a ``site`` column (``versions.current_sites`` for series and customers).
    """

    def place(table: str) -> str:
        return f"{store}/{table}/site={site}"

    series = exports.read_export(spark, files.series, schema.OPEN_SERIES)
    versions.full_refresh(series, place("openseries"))
    customers = exports.read_export(spark, files.customers, schema.CUSTOMERS)
    versions.full_refresh(customers, place("cust"))
    sales = exports.read_export(spark, files.sales, schema.SALES)
    tables.replace_range_at(spark, place("sale"), sales, "dt", grain)
    attendance = exports.read_export(
        spark,
        files.attendance,
        schema.ATTENDANCE,
        required_header=schema.ATTENDANCE_HEADER,
    )
    load_attendance(spark, place("attend"), attendance, grain)
