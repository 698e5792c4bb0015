"""Role views: the test tables seen as studio tables.

customer -> cust, orders x lineitem x part -> sale, shipped lines or events -> attendance,
orders -> open series and memberships, events -> probes. Derived columns are plain
arithmetic on keys, so both engines of the comparison compute the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that building a query reads no file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def cust(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1925-01-01").cast("date"), (key * 7919 % 26000).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            key.alias("id"),
            F.col("c_name").alias("firstname"),
            F.col("c_mktsegment").alias("lastname"),
            _text("c", key, "@example.test").alias("emailaddress"),
            _text("555-", key).alias("phone"),
            _text("556-", key).alias("phone2"),
            F.col("n_name").alias("city"),
            F.date_add(F.lit("1998-01-01").cast("date"), (key * 37 % 400).cast("int")).alias(
                "datecreated"
            ),
            F.when(key % 10 != 0, born).alias("birthdate"),
        )
    )


def sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    refund = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.col("o_orderdate").alias("dt"),
            F.col("o_custkey").alias("custid"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Comp")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Store Credit")
            .otherwise("Card")
            .alias("pmtype"),
            F.when(refund, -price).otherwise(price).cast("decimal(18,2)").alias("total"),
            F.col("p_name").alias("item"),
            F.when(F.col("p_type") == "ECONOMY", "series")
            .otherwise(F.lower("p_type"))
            .alias("typ"),
            F.col("o_orderstatus").alias("studio"),
        )
    )


def attend_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance from shipped lines; it has no unique id."""
    hour = (6 + F.col("l_suppkey") % 12).cast("int")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("custid"),
            F.when(F.col("l_linestatus") == "F", "Enrolled").otherwise("Cancelled").alias("status"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hour)).alias("classdate"),
            _text("I", F.col("l_suppkey") % 10).alias("inst"),
            F.col("l_returnflag").alias("room"),
            F.col("l_returnflag").alias("classtype"),
        )
    )


def attend_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance from events; ``id`` is unique."""
    return attend_from(table(spark, sf_dir, "events"))


def attend_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("custid"),
        _text("Rider ", F.col("user_id")).alias("firstname"),
        _text("Group ", F.col("user_id") % 10).alias("lastname"),
        _text("c", F.col("user_id"), "@example.test").alias("emailaddress"),
        F.when(F.col("event_type") == "error", "Cancelled").otherwise("Enrolled").alias("status"),
        F.col("ts").alias("datein"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("classdate"),
        _text("I", F.hour("ts") % 7).alias("inst"),
        F.col("event_type").alias("room"),
        F.col("event_type").alias("classtype"),
    )


def openseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "O")
        .select(
            _text("c", F.col("o_custkey"), "@example.test").alias("emailaddress"),
            F.col("o_orderpriority").alias("series"),
            F.lit(10).alias("count"),
            (F.col("o_orderkey") % 11).alias("remaining"),
            F.col("o_orderdate").alias("purchdt"),
        )
    )


def occ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per class and site."""
    return (
        attend_ship(spark, sf_dir)
        .groupBy(F.col("classdate").alias("dt"), _text("site", F.col("custid") % 5).alias("site"))
        .agg(
            F.min("inst").alias("instr"),
            F.count(F.when(F.col("status") == "Enrolled", 1)).alias("unavail"),
            (F.count(F.lit(1)) + 2).alias("total"),
        )
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(
            F.col("o_custkey").alias("member"),
            F.date_add(F.to_date("o_orderdate"), 30).alias("expiry"),
        )
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes_from(table(spark, sf_dir, "events"))


def probes_from(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("user_id") % 3).alias("target"),
        "ts",
        "event_id",
        F.col("event_type").isin("error", "click").cast("int").alias("down"),
    )


def capacity(spark: SparkSession) -> DataFrame:
    """Seats per site: a fixed dimension, one row per site of the ``occ`` role."""
    return spark.range(5).select(
        _text("site", F.col("id")).alias("site"), (3 + F.col("id") % 2).cast("int").alias("seats")
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")
