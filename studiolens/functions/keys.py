"""Small relational helpers that keep hot keys out of single tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTACT = ["firstname", "lastname", "emailaddress", "phone", "phone2"]


def key_set(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct non-NULL values of a column.

    Semi and anti joins cannot split a hot key on their right side. With this the right
    side holds each key once: duplicates go away before the shuffle, map-side.
    """
    return (
        df.where(F.col(column).isNotNull())
        .select(F.col(column).alias(name or column))
        .distinct()
    )


def with_contacts(df: DataFrame, cust: DataFrame, key: str = "custid") -> DataFrame:
    """Inner join of per-customer rows to the contact columns of ``cust``."""
    contacts = cust.select(F.col("id").alias(key), *CONTACT)
    return df.join(contacts, key, "inner")

