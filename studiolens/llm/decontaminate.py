"""Find texts of a benchmark in documents, and remove the spans or the documents.

Words are runs of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z. A window is
``window`` consecutive words of an item, or all words of a shorter item. First the documents
that may hold a window are found: of any occurrence, half a window lies at a place that is a
multiple of its own length, so only every fifth group of five words is hashed and probed against the
hashes of all such groups of the benchmark. Then the windows of just these documents are compared as
text. The benchmark's tables are written first, so Spark knows their sizes: it broadcasts them below its
threshold and shuffles beyond.

Defined cases: a null text has no words and no hits; an item without words has no window; items
that share an item_id are one item, and those without it are one item of empty name; repeated
rows get the same result each; empty tables give no hits or no rows. Columns of the input are
kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.shared import ascii_lower, columns_of, staged

WINDOW = 10
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before lower-casing.
_CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(_WORD), F.lit(0))


def half(length: int) -> int:
    """The longest group that lies, at a multiple of its length, within any ``length`` words."""
    return (length + 1) // 2


def _key() -> Column:
    return F.struct("doc_id", F.xxhash64("text").alias("h"))


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item``, ``words`` and their number ``n`` for each window of each item."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("all")
    ).where("size(all) > 0")
    return items.withColumn("n", F.least(F.size("all"), F.lit(window))).select(
        "item", "n", F.explode(F.expr("transform(sequence(1, size(all) - n + 1), i -> slice(all, i, n))")).alias("words")
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Occurrences (``key``, ``at``, ``n``, ``phrase``) and the phrases of items (``item``, ``phrase``)."""
    windows = windows_of(benchmark, window)
    phrases = staged(windows.select("item", "n", F.array_join("words", " ").alias("phrase"), "words").distinct(), "windows")
    lengths = sorted(row[0] for row in phrases.select("n").distinct().collect())
    groups = sorted({half(n) for n in lengths})

    def seeds(words: str, step: int, by: int) -> Column:
        """Hashes of ``step`` words, at every ``by``-th place."""
        last = f"size({words}) - {step}"
        places = f"if({last} < 0, array(), sequence(0, {last}, {by}))"
        return F.expr(f"transform({places}, i -> xxhash64({step}, slice({words}, i + 1, {step})))")

    def seeds_for(by_place: bool) -> Column:
        return F.concat(*[seeds("words", g, g if by_place else 1) for g in groups])

    if not groups:  # a benchmark without words
        nothing = docs.where(F.lit(False)).select(_key().alias("key"))
        return nothing.selectExpr("key", "0 AS at", "0 AS n", "'' AS phrase"), phrases.select("item", "phrase")

    known = staged(phrases.select(F.explode(seeds_for(False)).alias("seed")).distinct(), "seeds")
    split = docs.select(_key().alias("key"), words_of(F.col("text")).alias("words"))
    maybe = staged(
        split.select("key", F.explode(seeds_for(True)).alias("seed")).join(known, "seed", "left_semi").select("key").distinct(),
        "suspects",
    )
    suspects = docs.select("text", _key().alias("key")).join(maybe, "key", "left_semi")
    every = F.concat(
        *[
            F.expr(
                f"transform(if(size(words) < {n}, array(), sequence(0, size(words) - {n})), i -> "
                f"named_struct('at', i, 'n', {n}, 'phrase', array_join(slice(words, i + 1, {n}), ' ')))"
            )
            for n in lengths
        ]
    )
    placed = suspects.select("key", words_of(F.col("text")).alias("words")).select("key", F.inline(every))
    whole = staged(phrases.select("n", "phrase").distinct(), "phrases")
    return (
        placed.join(whole, ["n", "phrase"], "left_semi").select("key", "at", "n", "phrase").distinct(),
        phrases.select("item", "phrase"),
    )


def with_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with :data:`ADDED`."""
    docs = docs.drop(*ADDED)
    found, phrases = hits(docs, benchmark, window)
    found = staged(found, "hits")
    covered = (
        found.select("key", F.explode(F.expr("sequence(at, at + n - 1)")).alias("place"))
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        found.select("key", "phrase")
        .distinct()
        .join(phrases, "phrase")
        .groupBy("key")
        .agg(F.collect_set("item").alias("items"))
    )
    result = staged(
        covered.join(items, "key").withColumnsRenamed({"key": "__key_", "items": "__items", "n_hit": "__n_hit"}),
        "contaminated",
    )
    names = F.array_join(F.array_sort(F.coalesce("__items", F.array().cast("array<string>"))), ",")
    n_hit = F.coalesce("__n_hit", F.lit(0))
    counted = docs.withColumns(
        {"__key": _key(), "n_words": F.coalesce(F.regexp_count("text", F.lit(_CASED)), F.lit(0)).cast("long")}
    )
    return (
        counted.join(result, F.col("__key") == F.col("__key_"), "left")
        .withColumns(
            {
                "contaminated": n_hit > 0,
                "n_items": F.coalesce(F.size("__items"), F.lit(0)).cast("long"),
                "items_sha256": F.sha2(names, 256),
                "n_hit": n_hit.cast("long"),
            }
        )
        .drop("__key", "__key_", "__items", "__n_hit")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any window, with the columns of ``docs``."""
    found, _ = hits(docs, benchmark, window)
    hit = staged(found.select(F.col("key").alias("__key")).distinct(), "contaminated")
    return docs.withColumn("__key", _key()).join(hit, "__key", "left_anti").select(*columns_of(docs))


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, the words within any window taken out of their text."""
    found, _ = hits(docs, benchmark, window)
    spans = staged(found.groupBy(F.col("key").alias("__key")).agg(F.collect_set(F.struct("at", "n")).alias("__spans")), "spans")
    cut = F.expr(
        "array_join(zip_with(__gaps, __words, (gap, word) -> concat(gap, coalesce(word, ''))), '')"
    )
    kept = F.expr(
        "transform(__words, (word, i) -> if(exists(__spans, s -> i >= s.at and i < s.at + s.n), '', word))"
    )
    return (
        docs.withColumn("__key", _key())
        .join(spans, "__key", "left")
        .withColumns(
            {
                "__gaps": F.when(F.col("__spans").isNotNull(), F.split("text", _CASED, -1)),
                "__words": F.when(F.col("__spans").isNotNull(), F.regexp_extract_all("text", F.lit(_CASED), F.lit(0))),
            }
        )
        .withColumn("__words", kept)
        .withColumn("text", F.coalesce(cut, F.col("text")))
        .select(*columns_of(docs))
    )
