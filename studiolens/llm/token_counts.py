"""Token counts of whole texts; huge texts are counted in overlapping chunks.

A huge text is cut into chunks that overlap, which are dealt out over the cluster and encoded with
the offsets of their tokens. Neighbours are spliced at the first token that both have in their
overlap. That this boundary is stable is a property of the encoder: it merges the best pair of
neighbouring symbols as long as there is one, so a row of tokens is the encoding of its text
exactly if each two neighbours are the encoding of theirs (the first merge across a boundary would
also be made in those two alone). Up to the common token neighbours are such a pair in the one
chunk, from it on in the other, so the spliced row is the encoding of both chunks together. Each
chunk but the first is encoded behind a character that is in no piece, so that no blank is put
before it. No kind of character is needed for a splice: texts without blanks are cut like others.

Two chunks may have no token in common, as in a long run of one letter. Such a text is
counted in order instead: the next chunk begins at a token of the one before, and where even
that gives no common token, chunks and overlaps are widened until they align or hold the text.

Defined cases: a null or empty text has 0 tokens; repeated rows are counted each; an empty
table gives no rows. Columns of the input are kept, those named in :data:`ADDED` are replaced.
With a model that is not of this kind (:func:`aligns`) texts are encoded whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
ADDED = ("n_bytes", "n_tokens", "over_limit")

# A text with more characters than this is huge. Chunks have that many, and the overlap.
CHUNK = 32_768
OVERLAP = 256

# Texts encoded by one call.
_BATCH = 64

# In no piece, so nothing is merged with it.
FENCE = "\n"

# Kinds of pieces that depend on no more than their characters: normal, unknown, control, byte.
_PLAIN = {1, 2, 3, 6}
_MERGES = 2

_PIECE = pa.schema(
    [("key", pa.string()), ("k", pa.int64()), ("size", pa.int64()), ("last", pa.bool_()), ("piece", pa.string())]
)
_SEAM = pa.schema(
    [("key", pa.string()), ("seam", pa.int64()), ("n", pa.int64()), ("left", pa.binary()), ("right", pa.binary())]
)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{field.name} {kinds[field.type]}" for field in schema)


def load(model: str):
    """The encoder; ``model`` is a file of public_tokenizers or a path that executors see."""
    import os

    import sentencepiece

    if not os.path.exists(model):
        import public_tokenizers

        model = public_tokenizers.path(model)
    return sentencepiece.SentencePieceProcessor(model_file=model)


def aligns(encoder) -> bool:
    """Whether encodings can be spliced at a common token: merges only, texts taken as they are."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(encoder.serialized_model_proto())
    rules, trained = model.normalizer_spec, model.trainer_spec
    as_it_is = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces
    merges = trained.model_type == _MERGES and trained.byte_fallback
    return as_it_is and merges and all(p.type in _PLAIN and FENCE not in p.piece for p in model.pieces)


def chunks_of(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple[int, bool, str]]:
    """(number, last, piece); a piece goes on into its successor by the overlap."""
    for k in itertools.count():
        stop = (k + 1) * chunk + overlap
        yield k, stop >= len(text), text[k * chunk : stop]
        if stop >= len(text):
            return


def spans(encoder, piece: str, first: bool) -> np.ndarray:
    """Begin and end of each token in bytes. The bytes of a character without a piece begin
    together, and only the last of them has an end beyond its begin."""
    fence = "" if first else FENCE
    tokens = encoder.encode(fence + piece, return_type="proto").pieces
    places = np.array([(t.begin, t.end) for t in tokens], np.int64).reshape(-1, 2) - len(fence)
    return places[places[:, 0] >= 0]


def common(left: np.ndarray, right: np.ndarray) -> int | None:
    """Where the first token begins that two encodings have both, None if there is none."""
    whole = [side[side[:, 0] < side[:, 1]] for side in (left, right)]
    one, other = ((side[:, 0] << 32) | side[:, 1] for side in whole)
    both = np.intersect1d(one, other)
    return int(both[0] >> 32) if len(both) else None


def surplus(left: bytes, right: bytes) -> int | None:
    """Tokens around a cut that are counted but not in the spliced row: those of the left chunk
    from the splice on, and those of the right one before it."""
    sides = [np.frombuffer(side, np.int64).reshape(-1, 2) for side in (left, right)]
    at = common(*sides)
    if at is None:
        return None
    return int((sides[0][:, 0] >= at).sum() + (sides[1][:, 0] < at).sum())


def seams_of(encoder, k: int, last: bool, piece: str, chunk: int, overlap: int) -> Iterator[tuple]:
    """(seam, tokens, left, right): the tokens of a piece, and those near its cuts, from the cut on."""
    tokens = spans(encoder, piece, k == 0)
    until = len(piece[:overlap].encode())
    yield k, len(tokens), None, tokens[tokens[:, 0] < until].tobytes() if k else None
    if not last:
        cut = len(piece[:chunk].encode())
        yield k + 1, 0, (tokens[tokens[:, 0] >= cut] - cut).tobytes(), None


def count_in_order(encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, chunk after chunk; chunks are widened where they do not align."""
    while chunk + overlap < len(text):
        total = _in_order(encoder, text, chunk, overlap)
        if total is not None:
            return total
        chunk, overlap = 2 * chunk, 2 * overlap
    return len(encoder.encode(text))


def _in_order(encoder, text: str, chunk: int, overlap: int) -> int | None:
    start = total = counted = 0
    piece = text[: chunk + overlap]
    tokens = spans(encoder, piece, True)
    while start + len(piece) < len(text):
        cut = len(piece[:chunk].encode())
        tail = tokens[np.searchsorted(tokens[:, 0], cut) :]
        if not len(tail):
            return None
        at = int(tail[0, 0])
        start += len(piece.encode()[:at].decode())
        piece = text[start : start + chunk + overlap]
        following = spans(encoder, piece, False)
        splice = common(tail - at, following)
        if splice is None:
            return None
        total += int(((tokens[:, 0] >= counted) & (tokens[:, 0] < at + splice)).sum())
        tokens, counted = following, splice
    return total + int((tokens[:, 0] >= counted).sum())


def with_token_counts(
    docs: DataFrame, model: str = MODEL, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load(model)
        for batch in batches:
            numbers: list[int] = []
            for i in range(0, len(batch), _BATCH):
                texts = [t or "" for t in batch.slice(i, _BATCH).to_pylist()]
                numbers.extend(len(ids) for ids in encoder.encode(texts, num_threads=1))
            yield pa.array(numbers, pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = aligns(load(model))
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = chunk if parts else len(text)
                for k, last, piece in chunks_of(text, size, overlap):
                    row = {"key": key, "k": k, "size": size, "last": last, "piece": piece}
                    yield pa.RecordBatch.from_pylist([row], schema=_PIECE)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(model)
        for batch in batches:
            for r in batch.to_pylist():
                found = seams_of(encoder, r["k"], r["last"], r["piece"], r["size"], overlap)
                rows = [dict(zip(_SEAM.names, (r["key"], *seam), strict=True)) for seam in found]
                yield pa.RecordBatch.from_pylist(rows, schema=_SEAM)

    @F.arrow_udf("long")
    def splice(left: pa.Array, right: pa.Array) -> pa.Array:
        sides = zip(left.to_pylist(), right.to_pylist(), strict=True)
        return pa.array([0 if a is None or b is None else surplus(a, b) for a, b in sides], pa.int64())

    @F.arrow_udf("long")
    def in_order(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = load(model)
        known: dict[str, int] = {}
        for keys, texts in columns:
            numbers = []
            for key, text in zip(keys.to_pylist(), texts, strict=True):
                if text.is_valid and key not in known:
                    known[key] = count_in_order(encoder, text.as_py(), chunk, overlap)
                numbers.append(known.get(key))
            yield pa.array(numbers, pa.int64())

    docs = docs.drop(*ADDED)
    is_huge = F.length(F.coalesce("text", F.lit(""))) > chunk
    plain = docs.where(~is_huge).withColumn("n_tokens", count("text"))

    # Each different huge text is counted once; its chunks are dealt out by number. A count is
    # NULL if one of its seams has no common token.
    huge = docs.where(is_huge).withColumn("__key", F.sha2("text", 256))
    pieces = huge.select("__key", "text").dropDuplicates(["__key"]).mapInArrow(cut, _ddl(_PIECE))
    seams = (
        pieces.repartition("key", "k")
        .mapInArrow(encode, _ddl(_SEAM))
        .groupBy("key", "seam")
        .agg(*[F.max(c).alias(c) for c in ("n", "left", "right")])
        .select("key", "n", splice("left", "right").alias("surplus"))
    )
    open_seams = F.count(F.when(F.col("surplus").isNull(), 1))
    counts = seams.groupBy(F.col("key").alias("__key")).agg(
        F.when(open_seams == 0, F.sum("n") - F.sum("surplus")).alias("__n")
    )
    left_over = F.when(F.col("__n").isNull(), F.col("text"))
    spliced = (
        huge.join(counts, "__key")
        .withColumn("n_tokens", F.coalesce("__n", in_order("__key", left_over)))
        .drop("__key", "__n")
    )
    return plain.unionByName(spliced).withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
            "over_limit": F.col("n_tokens") > limit,
        }
    )
