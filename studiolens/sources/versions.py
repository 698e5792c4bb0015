"""Full refresh: tables that are replaced as a whole.

A refresh writes a folder of its own within the table. Creating an empty marker beside it makes
that version the table's current one: a single step on any file system, without a rename. A
reader finds the newest marker and reads one whole version, whatever loads do meanwhile; a load
that is killed at any moment leaves the version before it. The version that was replaced stays
for readers that have begun, older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from studiolens.session import children, remove_dir, write_text

# Names beginning with an underscore are hidden from plain readers of the folder.
_ROWS, _DONE = "_rows-", "_done-"


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions, the oldest first; the number in front orders them."""
    return [name.removeprefix(_DONE) for name in children(spark, path) if name.startswith(_DONE)]


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table, once all new rows are written. A bad row changes nothing."""
    spark = df.sparkSession
    before = _versions(spark, path)
    number = int(before[-1].partition("-")[0]) + 1 if before else 1
    version = f"{number:012d}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{path}/{_ROWS}{version}")
    except Exception:
        remove_dir(spark, f"{path}/{_ROWS}{version}")
        raise
    write_text(spark, f"{path}/{_DONE}{version}")
    for old in before[:-1]:
        remove_dir(spark, f"{path}/{_DONE}{old}")
        remove_dir(spark, f"{path}/{_ROWS}{old}")


def current_path(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version, None before the first refresh."""
    versions = _versions(spark, path)
    return f"{path}/{_ROWS}{versions[-1]}" if versions else None


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the current version, None before the first refresh."""
    folder = current_path(spark, path)
    return spark.read.parquet(folder) if folder else None


def current_sites(spark: SparkSession, path: str) -> DataFrame | None:
    """The current rows of all ``path/site=<site>`` tables, with a ``site`` column."""
    sites = [f"{path}/{name}" for name in children(spark, path) if name.startswith("site=")]
    folders = [folder for folder in (current_path(spark, site) for site in sites) if folder]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None
