"""Mix sources to target weights by repeating and thinning documents.

Tokens are summed per source; a source's rate is its target over its sum. Each document is
emitted floor(rate) times, and once more if a coin seeded by its own id and text falls below
the fraction. No document meets another one: only the sums per source are gathered.

Defined cases: a null text has size 0; null sources form one source that sorts last; a
source of size 0 has target 0 and is not emitted; repeated rows toss the same coin; an empty table gives
no rows. Columns of the input are kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studiolens.llm.shared import columns_of, SPACE, staged

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 7
ADDED = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def coin(seed: int, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the row's own id and text only."""
    own = F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))
    )
    return F.conv(F.substring(F.md5(own), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source its ``source_size`` and ``target``; ``sizes`` has ``source`` and ``size``.

    All sizes together are shared by weight. A source whose share would exceed ``most``
    times its size gets just that, and the excess goes to the others by weight. Ordered by
    size over weight the capped sources come first, so running sums give the final share in
    one pass over the table of sources, which has one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = per_source.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    )
    ratio = F.col("source_size") * most / F.col("weight")
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.col("source_size") * most).over(before), F.lit(0)
    )
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = (
        weighed.withColumn("ratio", ratio)
        .withColumn("level", left / open_weight)
        # The first source whose cap is not below the level, and all after it, stay uncapped.
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "rank", "level"))).over(everything)["level"])
    )
    target = F.least(
        (F.col("source_size") * most).cast("double"), F.col("weight") * F.col("level")
    )
    return shared.select("source", "source_size", target.alias("target"))


def with_copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and the number of ``copies``."""
    docs = docs.drop(*ADDED)
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    # Written, so that its size is known: the rates are then broadcast, and texts stay where they are.
    goal = staged(targets(sizes, weights, most).withColumnRenamed("source", "__source"), "rates")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = F.col("__coin") < rate - F.floor(rate)
    own = docs.withColumns(
        {"size": word_count(F.col("text")), "__coin": coin(seed, F.col("doc_id"), F.col("text"))}
    )
    return (
        own.join(goal, own["source"].eqNullSafe(goal["__source"]), "left")
        .withColumn("copies", (F.floor(rate) + extra.cast("long")).cast("long"))
        .drop("__source", "__coin")
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    copied = with_copies(docs, **how)
    return copied.withColumn(
        "__copy", F.explode(F.expr("array_repeat(0, cast(copies as int))"))
    ).select(*columns_of(docs))
