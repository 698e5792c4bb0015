"""Near copies by SimHash.

Each text gets a 64-bit fingerprint of its word shingles. Texts with equal fingerprints are
one class from then on, so a group of copies is one row. Fingerprints that differ in
few bits are found by pigeonhole: the 64 bits are cut into ``bits + SHARED`` blocks; a pair that
differs in at most ``bits`` bits agrees in at least ``SHARED`` of them, so it meets in the bucket of one
choice of blocks, where the Hamming distance is verified. A bucket that many fingerprints
share is cut into parts, and pairs of parts are compared in tasks of their own. A bucket
hands on no pairs, only links from each member to the smallest one it reaches within it,
at most as many as members.

Defined cases: a null text, an empty one and one without words have fingerprint 0 and link like
any other; repeated rows share a class; an empty table gives no rows; rows without a doc_id get the
smallest id of their component, if there is one. Columns of the input are kept, those named in
:data:`ADDED` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.components import connected_components
from studiolens.llm.shared import staged

WORDS = 5
BITS = 4
SHARED = 2
SEED = 42
ADDED = ("fingerprint", "component_id")

# Fingerprints of a bucket that one task compares.
PART = 2048

# Shingles that are hashed and counted at once.
_AT_ONCE = 65_536


def _word_edges(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of ``data`` joined by single blanks, and where each begins and ends.

    Holds arrays, not an object per word, so a text of any length takes a small multiple of its size.
    """
    codes = np.frombuffer(data.lower(), np.uint8)  # lower() of bytes: A-Z
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    first = ~space & np.concatenate([[True], space[:-1]])
    keep = ~space
    keep[np.flatnonzero(first)[1:] - 1] = True  # one blank before each word but the first
    joined = np.where(space, np.uint8(32), codes)[keep]
    blanks = np.flatnonzero(joined == 32)
    return joined.tobytes(), np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(joined)]])


def fingerprint(data: bytes, words: int = WORDS, seed: int = SEED) -> bytes:
    """Eight bytes: a bit is set if it is in over half the hashes of the text's shingles."""
    import xxhash

    if not data or data.isspace():
        return bytes(8)
    joined, begins, ends = _word_edges(data)
    width = min(words, len(begins))
    begins, ends = begins[: len(begins) - width + 1], ends[width - 1 :]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(begins), _AT_ONCE):
        spans = zip(begins[i : i + _AT_ONCE].tolist(), ends[i : i + _AT_ONCE].tolist(), strict=True)
        table = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in spans]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(table, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(begins)).tobytes()


def fingerprints(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """The fingerprint of each text as a long."""

    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own = [fingerprint(t or b"", words, seed) for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.array(np.frombuffer(b"".join(own), ">i8").astype(np.int64))

    return compute(text)


def block_masks(bits: int = BITS, shared: int = SHARED) -> list[int]:
    """A mask, as a signed long, for each choice of ``shared`` of the ``bits + shared`` blocks."""
    edges = np.linspace(0, 64, bits + shared + 1).astype(int).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(choice) for choice in combinations(blocks, shared)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links_within(members: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (index, index of the smallest member it reaches) that connect what is close."""
    labels, members = np.arange(len(members)), members.view(np.uint64)
    close = np.bitwise_count(members[:, None] ^ members[None, :]) <= bits
    while True:
        lower = np.where(close, labels[None, :], len(members)).min(axis=1)
        if (lower == labels).all():
            break
        labels = lower
    moved = np.flatnonzero(labels != np.arange(len(members)))
    return moved, labels[moved]


def close_links(prints: DataFrame, bits: int = BITS, part: int = PART) -> DataFrame:
    """Links (``a``, ``b``) that connect different fingerprints (column ``fp``) within ``bits``."""
    masks = block_masks(bits)
    pairs = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    buckets = prints.select("fp", F.inline(pairs))
    large = (
        buckets.groupBy("choice", "key")
        .count()
        .where(F.col("count") > part)
        .select("choice", "key", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    )
    # Each member meets each part of its bucket once: groups are pairs of parts.
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        buckets.join(large, ["choice", "key"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    )
    groups = (
        dealt.groupBy("choice", "key", F.least("own", "other"), F.greatest("own", "other"))
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.values.to_numpy(zero_copy_only=False)
            a, b = [], []
            ends = column.offsets.to_numpy().tolist()
            for begin, end in zip(ends, ends[1:], strict=False):
                members = values[begin:end]
                if end - begin == 2:
                    if (int(members[0] ^ members[1]) & (2**64 - 1)).bit_count() <= bits:
                        a.append(members[:1])
                        b.append(members[1:])
                    continue
                high, low = links_within(members, bits)
                a.append(members[high])
                b.append(members[low])
            empty = np.zeros(0, np.int64)
            columns = [pa.array(np.concatenate([empty, *x])) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return groups.mapInArrow(link, "a long, b long")


def with_components(
    docs: DataFrame, words: int = WORDS, bits: int = BITS, seed: int = SEED, part: int = PART
) -> DataFrame:
    """``docs`` without its text, with its ``fingerprint`` (hex) and ``component_id``.

    The component is named by the smallest doc_id reachable.
    """
    return _grouped(docs, words, bits, seed, part).drop("__component")


def _grouped(
    docs: DataFrame, words: int = WORDS, bits: int = BITS, seed: int = SEED, part: int = PART
) -> DataFrame:
    """The same with ``__component``, the component's smallest fingerprint."""
    slim = docs.drop(*ADDED).withColumn("__fp", fingerprints(F.col("text"), words, seed)).drop("text")
    printed = staged(slim, "fingerprints")
    classes = staged(printed.groupBy(F.col("__fp").alias("fp")).agg(F.min("doc_id").alias("first")), "classes")
    component = connected_components(close_links(classes, bits, part))
    labelled = classes.join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    first = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    member = labelled.join(first, "component").select(
        F.col("fp").alias("__fp_"), F.col("component").alias("__component"), "component_id"
    )
    return (
        printed.join(member, F.col("__fp") == F.col("__fp_"))
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("__fp"), 16, "0")))
        .drop("__fp", "__fp_")
    )


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """One document of each component, with the columns of ``docs``: the smallest doc_id.

    Of rows that share this doc_id one stays, and one of a component without any doc_id.
    Whole texts are shuffled once, to the keys of the rows that stay.
    """
    hashed = F.xxhash64("text").alias("__h")
    ids = docs.select("doc_id", "text", hashed)
    kept = (
        _grouped(ids, **how)
        .groupBy("__component")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__h")).alias("first"))
        .select(F.struct("first.doc_id", "first.__h").alias("__key"))
    )
    found = docs.withColumn("__key", F.struct("doc_id", hashed))
    return found.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
