"""Language of texts from hyperdimensional profiles.

Every letter has a random vector of signs, drawn from a generator seeded by its code point. Three
neighbouring letters are bound into one vector: the vectors of the first, second and third are
permuted by two, one and no places and multiplied. The vectors of all such trigrams of a text add up to
the vector of the text, those of all texts of a language to its prototype, and a text gets the language whose
prototype has the largest cosine with it. Letters are lower-cased; runs of anything else count
as one blank, which is a letter here, so that beginnings and ends of words are seen.

Prototypes are learned from all rows given for it: each task adds up vectors per language, and the
sums per language and dimension are added up by Spark, so what reaches the driver is languages x dimensions
numbers.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without
language teach nothing; without any row to learn from every text is ``und``; ties go to the
smaller name; repeated rows count each; an empty table gives no rows. Columns of the input are
kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.shared import columns_of

DIMENSIONS = 1024
UNKNOWN = "und"
ADDED = ("lang_pred", "score")

# Trigram vectors a task keeps.
_CACHED = 20_000

# Characters of a text that are looked at at once.
_AT_ONCE = 1 << 20

_BLANK = 32


class Profiler:
    """Vectors of texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self._dimensions = dimensions
        self._letters: dict[int, np.ndarray] = {}
        self._rows: dict[int, int] = {}
        self._table = np.zeros((1024, dimensions), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self._letters:
            bits = np.random.default_rng(code).integers(0, 2, self._dimensions)
            self._letters[code] = (2 * bits - 1).astype(np.int8)
        return self._letters[code]

    def _row(self, gram: int) -> int:
        """The row of the table that holds the vector of a trigram."""
        row = self._rows.get(gram)
        if row is None:
            a, b, c = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
            row = len(self._rows)
            if row == len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._table[row] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            self._rows[gram] = row
        return row

    def vector(self, text: str | None) -> np.ndarray | None:
        """The sum of the vectors of all trigrams, or None if there is no letter."""
        total, seen = np.zeros(self._dimensions), False
        text = text or ""
        for at in range(0, len(text), _AT_ONCE):
            # Parts overlap by two characters, so no trigram is lost.
            grams = trigrams(text[max(0, at - 2) : at + _AT_ONCE])
            if not len(grams):
                continue
            seen = True
            kinds, counts = np.unique(grams, return_counts=True)
            # A text in a large script may hold more trigrams than are kept.
            for i in range(0, len(kinds), _CACHED):
                if len(self._rows) > _CACHED:
                    self._rows.clear()
                rows = [self._row(g) for g in kinds[i : i + _CACHED].tolist()]
                total += counts[i : i + _CACHED].astype(np.float32) @ self._table[rows]
        return total if seen else None


def _letter(code: int) -> int:
    """The lower-case letter, or a blank."""
    char = chr(code)
    if not char.isalpha():
        return _BLANK
    low = char.lower()
    return ord(low) if len(low) == 1 else code


def _letters_table() -> np.ndarray:
    """The letters of the basic plane."""
    return np.array([_letter(code) for code in range(0x10000)], np.int64)


_LETTERS: list[np.ndarray] = []


def trigrams(text: str) -> np.ndarray:
    """Three letters of 21 bits each, for each trigram with a letter in its middle or at an end."""
    if not _LETTERS:
        _LETTERS.append(_letters_table())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = _LETTERS[0][np.minimum(raw, 0xFFFF)]
    far = raw > 0xFFFF
    if far.any():
        kinds, place = np.unique(raw[far], return_inverse=True)
        codes[far] = np.array([_letter(code) for code in kinds.tolist()])[place]
    codes = np.concatenate([[_BLANK], codes, [_BLANK]])
    codes = codes[np.concatenate([[True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)])]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def prototypes(rows: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Names of the languages and their unit prototypes, learned from ``text`` and ``lang``."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(dimensions), {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                vector = profiler.vector(text.as_py())
                if vector is not None:
                    sums[lang] = sums.get(lang, 0) + vector
        columns = [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "vector"])

    partial = rows.where("lang IS NOT NULL").select("text", "lang").mapInArrow(learn, "lang string, vector array<double>")
    totals = (
        partial.select("lang", F.posexplode("vector").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("i", "x")))["x"].alias("vector"))
        .orderBy("lang")
        .collect()
    )
    table = np.array([row["vector"] for row in totals]).reshape(len(totals), dimensions)
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    return [row["lang"] for row in totals], table / np.where(lengths > 0, lengths, 1)


def predicted(text: Column, names: list[str], table: np.ndarray) -> Column:
    """A struct of ``lang_pred`` and ``score``."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profiler = Profiler(table.shape[1])
        for batch in batches:
            found = []
            for text in batch:
                vector = profiler.vector(text.as_py()) if names else None
                length = 0 if vector is None else np.linalg.norm(vector)
                if length == 0:
                    found.append({"lang_pred": UNKNOWN, "score": 0.0})
                    continue
                cosines = table @ (vector / length)
                best = int(cosines.argmax())
                score = min(1.0, max(0.0, float(cosines[best])))
                found.append({"lang_pred": names[best], "score": score})
            yield pa.array(found, kind)

    return predict(text)


def with_language(docs: DataFrame, teachers: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; ``teachers`` have ``text`` and ``lang``."""
    names, table = prototypes(teachers, dimensions)
    docs = docs.drop(*ADDED)
    return (
        docs.withColumn("__found", predicted(F.col("text"), names, table))
        .withColumns({"lang_pred": F.col("__found.lang_pred"), "score": F.col("__found.score")})
        .drop("__found")
    )


def held_out(doc_id: Column) -> Column:
    """The rows that must not teach: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spoken(docs: DataFrame, teachers: DataFrame, languages: list[str] | None = None, least: float = 0.0) -> DataFrame:
    """The documents in one of ``languages`` (default: any that was learned).

    A document goes if it has no letters, if its language isn't wanted, or if its cosine is not
    above ``least``. A text of few words has a small cosine even if it is plainly in its language.
    """
    judged = with_language(docs, teachers)
    wanted = F.col("lang_pred") != UNKNOWN if languages is None else F.col("lang_pred").isin(languages)
    return judged.where(wanted & (F.col("score") > least)).select(*columns_of(docs))
