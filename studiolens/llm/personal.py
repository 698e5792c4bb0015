"""Find personal data, and the words that give it away.

Base kinds are found by pattern. From there on the method is information-theoretic: the values found are
the protected entities; a word near one is a term. Over all documents it is counted how many hold
a term, and in how many it stands near an entity. Of the information content of the entity, -log2 P(e),
a term reveals log2 (P(e|t) / P(e)). P(e|t) is shrunk towards P(e) by a part of a document, so that few documents
count for less than many, and an entity of a single document can still be disclosed. A term that reveals
at least a share of the content discloses the entity; it becomes a span of kind ``term`` wherever it stands, and
:func:`sanitised` generalises or removes it like the others. Copies of a text count once.

Only built-in functions run here. Positions are counted in code points from the lengths of what lies
between the matches. The patterns are the plain ones made possessive, with a look behind, so that
no text makes them slow or deep: what begins within a run of fitting characters needs no try, as it fails or
matches as the run itself does.

Defined cases: a null or empty text has no spans; a match that fails its test is dropped
without another try; spans of different kinds may overlap, but a term within a base span is
not listed; repeated rows get the same result each; an empty table gives no rows. Columns of the input
are kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.shared import ascii_lower, columns_of, staged

# Kinds in the order of lists of spans.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ADDED = ("spans", "term_spans")

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot match.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Words on either side of a value that count as near, up to the next value of its kind.
NEAR = 5
_LETTER = r"\p{L}\p{M}"
# Words of a gap between values; one that touches the value is a part of a word and left out.
_LEFT_WORD = f"(?<![{_LETTER}])[{_LETTER}]{{3,}}+(?=[^{_LETTER}])"
_RIGHT_WORD = f"(?<=[^{_LETTER}])[{_LETTER}]{{3,}}+"

# Matches whose places are summed by one fold. A fold copies what it has found with each match, so
# blocks are folded one by one, from where they start.
_BLOCK = 256

# The share of an entity's information content that makes a term disclosing, and the documents
# without evidence that are added to those that hold the term.
DISCLOSURE = 0.9
PRIOR = 0.25


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: Column, context: bool = False) -> Column:
    """Matches as structs of ``at``, ``end``, ``value``; with ``context`` also the texts ``left`` and
    ``right`` of them, up to the next match. Takes time in proportion to text and matches."""

    def parts_of(cut: Column) -> Column:
        n = F.size(cut["values"])
        parts = F.zip_with(
            F.slice(cut["between"], 1, n),
            cut["values"],
            lambda left, value: F.struct(left.alias("left"), value.alias("value")),
        )
        if not context:
            return parts
        rights = F.slice(cut["between"], 2, n)
        return F.zip_with(parts, rights, lambda part, right: part.withField("right", right))

    def blocks_of(parts: Column) -> Column:
        last = F.greatest(F.ceil(F.size(parts) / _BLOCK).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(parts, i * _BLOCK + 1, _BLOCK))

    def length(part: Column) -> Column:
        return F.length(part["left"]) + F.length(part["value"])

    def starts_of(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, part: n + length(part)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(
            sizes,
            start,
            lambda state, size: F.struct(
                (state["at"] + size).alias("at"),
                F.concat(state["starts"], F.array(state["at"])).alias("starts"),
            ),
        )["starts"]

    names = ["value", "left", "right"] if context else ["value"]
    kind = "array<struct<at:int,end:int," + ",".join(f"{n}:string" for n in names) + ">>"

    def step(state: Column, part: Column) -> Column:
        at = state["at"] + F.length(part["left"])
        end = at + F.length(part["value"])
        one = F.struct(at.alias("at"), end.alias("end"), *[part[n].alias(n) for n in names])
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    def placed(blocks: Column) -> Column:
        def one(starts: Column) -> Column:
            def fold(block: Column, i: Column) -> Column:
                start = F.struct(F.get(starts, i).alias("at"), F.array().cast(kind).alias("found"))
                return F.aggregate(block, start, step)["found"]

            return F.flatten(F.transform(blocks, fold))

        return _let(starts_of(blocks), one)

    cut = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("values"),
        F.split(text, pattern, -1).alias("between"),
    )
    return _let(_let(_let(cut, parts_of), blocks_of), placed)


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


_SPANS = "array<struct<kind:string,at:int,end:int,value:string,near:array<string>>>"


def _spans_of(kind: str, text: Column) -> Column:
    def words(gap: Column, pattern: str) -> Column:
        return F.regexp_extract_all(ascii_lower(gap), F.lit(pattern), F.lit(0))

    def named(found: Column) -> Column:
        before = F.slice(F.reverse(words(found["left"], _LEFT_WORD)), 1, NEAR)
        after = F.slice(words(found["right"], _RIGHT_WORD), 1, NEAR)
        near = F.array_distinct(F.concat(before, after))
        rest = [found[c].alias(c) for c in ("at", "end", "value")]
        return F.struct(F.lit(kind).alias("kind"), *rest, near.alias("near"))

    found = F.filter(located(text, F.lit(_PATTERNS[kind]), context=True), lambda x: _passes(kind, x["value"]))
    return F.when(text.rlike(_NEEDS[kind]), F.transform(found, named)).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """All base spans as structs of ``kind``, ``at``, ``end``, ``value`` and the terms ``near``."""
    return F.concat(*[_spans_of(kind, text) for kind in KINDS])


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"[{_LETTER}]{{3,}}"), F.lit(0))


def _entity(span: Column) -> Column:
    """What a span stands for, however it is written."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    plain = (
        F.when(span["kind"] == "email", ascii_lower(span["value"]))
        .when(span["kind"] == "ip", F.regexp_replace(span["value"], "(?<![0-9])0+(?=[0-9])", ""))
        .otherwise(digits)
    )
    return F.concat_ws(":", span["kind"], plain)


def disclosing(found: DataFrame, docs: DataFrame, share: float, prior: float) -> DataFrame:
    """Terms that disclose an entity; ``found`` has ``h`` (of the text) and its base ``spans``."""
    near = (
        found.select("h", F.explode("spans").alias("span"))
        .select("h", _entity(F.col("span")).alias("entity"), F.explode("span.near").alias("term"))
        .distinct()
    )
    texts = docs.select(F.xxhash64("text").alias("h")).distinct().count()
    entities = (
        found.select("h", F.explode("spans").alias("span"))
        .select("h", _entity(F.col("span")).alias("entity"))
        .distinct()
        .groupBy("entity")
        .agg((F.count(F.lit(1)) / max(texts, 1)).alias("p"))
    )

    def revealed(holding: str) -> Column:
        """The share of the entity's information content, if so many texts hold the term."""
        given = (F.col("both") + prior * F.col("p")) / (F.col(holding) + prior)
        return F.log2(given / F.col("p")) / -F.log2("p")

    # Texts with the term near any entity are a part of those that hold it: terms that would not
    # disclose even if these were all, as common words, need no count over the corpus. An
    # entity in every text has no information content to reveal.
    near_any = near.groupBy("term").agg(F.countDistinct("h").alias("near_any"))
    together = staged(
        near.groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("both"))
        .join(near_any, "term")
        .join(entities, "entity")
        .where((F.col("p") < 1) & (revealed("near_any") >= share)),
        "together",
    )
    # Many terms near some entity are common words: joined before counting they would give
    # documents x terms rows, so all words are counted, in the first of each text's copies.
    once = docs.select(F.xxhash64("text").alias("h"), "text").dropDuplicates(["h"])
    holding = (
        once.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("with_term"))
    )
    return together.join(holding, "term").where(revealed("with_term") >= share).select("term").distinct()


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``__key_`` and ``__places``: where ``terms`` stand in the documents that hold them."""
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    words = docs.select(key.alias("__key_"), F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    pairs = staged(words.join(terms, "term").distinct(), "holders")
    pattern = F.concat(F.lit(f"(?<![{_LETTER}])(?i:"), "term", F.lit(f")(?![{_LETTER}])"))
    texts = docs.select(key.alias("key"), "text")
    return (
        texts.join(pairs, texts["key"] == pairs["__key_"])
        .select("__key_", F.inline(located(F.col("text"), pattern)))
        .groupBy("__key_")
        .agg(F.array_sort(F.collect_set(F.struct("at", "end"))).alias("__places"))
    )


def with_spans(docs: DataFrame, share: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame:
    """``docs`` without its text, with ``spans`` (base) and ``term_spans``."""
    docs = docs.drop(*ADDED)
    text = F.coalesce("text", F.lit(""))
    found = staged(
        docs.withColumns({"__h": F.xxhash64("text"), "spans": base_spans(text)}).drop("text"), "spans"
    )
    some = found.where(F.size("spans") > 0).select(F.col("__h").alias("h"), "spans")
    terms = staged(disclosing(some, docs, share, prior), "disclosing")
    places = term_places(docs, terms)
    outside = F.filter(
        F.coalesce("__places", F.array().cast("array<struct<at:int,end:int>>")),
        lambda p: ~F.exists("spans", lambda s: (p["at"] < s["end"]) & (s["at"] < p["end"])),
    )
    key = F.struct("doc_id", F.col("__h").alias("h"))
    return (
        found.withColumn("__key", key)
        .join(places, F.col("__key") == F.col("__key_"), "left")
        .withColumn("term_spans", outside)
        .withColumn("spans", F.transform("spans", lambda s: s.dropFields("near")))
        .drop("__key", "__key_", "__places", "__h")
    )


def listed(kind: Column, at: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, at.cast("string"), end.cast("string"))


def sanitised(docs: DataFrame, remove_terms: bool = False, **how) -> DataFrame:
    """``docs`` with spans replaced by their kind in brackets, and terms so too or removed.

    Where spans overlap, the first one stands for all.
    """
    ids = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    kind = F.lit("" if remove_terms else f"[{TERM}]")
    cuts = F.concat(
        F.transform("spans", lambda s: F.struct(s["at"].alias("at"), s["end"].alias("end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("to"))),
        F.transform("term_spans", lambda s: F.struct(s["at"].alias("at"), s["end"].alias("end"), kind.alias("to"))),
    )
    spans = (
        with_spans(ids, **how)
        .select(F.struct("doc_id", F.col("hash").alias("h")).alias("__key_"), F.array_sort(cuts).alias("__cuts"))
        .where(F.size("__cuts") > 0)
        .dropDuplicates(["__key_"])
    )

    def step(state: Column, cut: Column) -> Column:
        piece = F.col("text").substr(state["at"] + 1, F.greatest(cut["at"] - state["at"], F.lit(0)))
        done = F.struct(cut["end"].alias("at"), F.concat(state["out"], piece, cut["to"]).alias("out"))
        inside = F.struct(F.greatest(state["at"], cut["end"]).alias("at"), state["out"].alias("out"))
        return F.when(cut["at"] < state["at"], inside).otherwise(done)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate("__cuts", start, step, lambda s: F.concat(s["out"], F.col("text").substr(s["at"] + 1, F.length("text"))))
    return (
        docs.withColumn("__key", F.struct("doc_id", F.xxhash64("text").alias("h")))
        .join(spans, F.col("__key") == F.col("__key_"), "left")
        .withColumn("text", F.coalesce(rest, F.col("text")))
        .select(*columns_of(docs))
    )
