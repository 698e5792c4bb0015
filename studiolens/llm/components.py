"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studiolens.llm.shared import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for each node of ``links`` (``a``, ``b``).

    Alternates large-star and small-star steps: each node hands its larger neighbours, then
    its smaller ones, over to the smallest node it sees. The table never has more rows than
    there are links, minima are formed before the shuffle, and a hub with many links is on the left side of
    its join, where Spark splits it. Each round is written, so lost executors cost one round.
    Links with a null end and loops are ignored; a node without links has no row.
    """
    table = staged(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        table = staged(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return table.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
