"""Helpers the operators of this subpackage share.

Columns the operators need for themselves beside those of the input begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.session import work_dir

# White space in the sense of these operators: blank and the controls from tab to return.
SPACE = " \\x09-\\x0D"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage: what was computed survives the loss of executors and is not computed
    twice. The folder stays, as the returned frame reads from it.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())
