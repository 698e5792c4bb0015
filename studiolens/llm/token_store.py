"""Token ids in files that give any single token without decoding a block.

An id is split into chunks of eight bits, low ones first. All first chunks form level 0, one byte
per token; a bitmap tells which tokens continue, and their next chunks form level 1, and so
on. A rank directory holds the number of set bits before each block of the bitmap, so the
place of a token's next chunk is one directory entry plus the bits of one block. A small id
takes one byte and one bit.

Documents are ordered by doc_id with a range shuffle; each task encodes its range and writes
files of bounded size into a shared folder. Their names and sums, one row per file, form the
manifest; running sums over it give each file its place in the whole. A file of a task that was
lost or run twice is not in the manifest and never read.

Defined cases: a null or empty text holds the end id only; documents without doc_id come
first; rows that share a doc_id are ordered by a hash of their text, and repeated rows are each encoded; an empty
table gives an empty manifest and no rows.

File, little-endian: levels (chunks; bitmap; directory), then doc ids (int64), their
validity (bytes), then token offsets (uint64, one more than documents), a JSON footer with
places and counts, its length (uint32), magic.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studiolens.llm.shared import staged
from studiolens.session import work_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"DACTOK01"

# Bits of a bitmap per entry of its rank directory.
BLOCK = 512

# A file is closed after the document with which it reaches this many tokens.
FILE_TOKENS = 8_000_000

# Bytes of texts that are taken apart at a time; a word is never cut.
_PART = 1 << 20

# Bytes a task may use for the ids of pieces it has met, and those of a piece beside its text.
_KEPT, _KEPT_EACH = 100_000_000, 200

# Kinds of bytes: white space; letters, digits and signs of plain words; what only the library knows to split.
_BLANK, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[ord("!") : ord("~") + 1] = _SIGN
_KIND[ord("a") : ord("z") + 1] = _KIND[ord("A") : ord("Z") + 1] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
# Contractions begin with the apostrophe.
_KIND[ord("'")] = _ODD
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _split(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the words in UTF-8 that begins and ends with white space.

    Returns the places where they begin, whether each is a whole word as it stands instead of a piece of a plain
    one in lower case, their bytes one after the other, and where each begins in these, with the end of the last.
    """
    kind, text = _KIND[raw], _LOWER[raw]
    # Letters from U+00C0 to U+00FF are C3 and a byte from 80 on; 97 and B7 are signs.
    first = np.flatnonzero(raw == 0xC3)
    second = raw[first + 1]
    letters = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
    first, second = first[letters], second[letters]
    kind[first] = kind[first + 1] = _LETTER
    text[first[second <= 0x9E] + 1] += 32
    # Special tokens begin so.
    kind[:-1][(raw[:-1] == ord("<")) & (raw[1:] == ord("|"))] = _ODD

    inside = kind != _BLANK
    begins = np.empty(len(raw), bool)
    begins[0] = False
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins |= kind == _DIGIT
    begins &= inside
    odd = kind == _ODD
    if odd.any():
        words = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        among = np.logical_or.reduceat(odd, words)
        odd[: words[0]] = False
        odd[words[0] :] = np.repeat(among, np.diff(words, append=len(raw)))
        np.copyto(text, raw, where=odd)
        begins &= ~odd
        begins[words[among]] = True
    places, text = np.flatnonzero(begins), text[inside]
    return places, odd[places], text, np.append(np.flatnonzero(begins[inside]), len(text))


def _values(column: pa.LargeBinaryArray) -> list[bytes]:
    """Values of a column without nulls, which ``to_pylist`` makes one scalar at a time."""
    _, bounds, text = column.buffers()
    at = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = text.to_pybytes() if text else b""
    return [data[a:b] for a, b in zip(at, at[1:], strict=False)]


class WordEncoder:
    """Ids of whole texts from the library, called once for each different piece of a word.

    The tokenizer must drop white space and never join what it separates; then the ids of a
    text are those of its words, one after the other. Of plain words it must take runs of letters, single digits
    and runs of anything else apart, in lower case; then the ids of such a word are those of these
    pieces. Both are tried on a probe, and texts are encoded whole by a tokenizer that does otherwise.

    Plain words are of printable ASCII and letters up to U+00FF, without special tokens and the apostrophe. Such
    a word has one form, and each letter one lower case. Other words are a piece each. Texts are split,
    and the different pieces found, by column; only these are handled one by one.
    """

    _PROBE = "Àß,é! Ab,Cd 12;x\ny--(z) ..\t7a  END"

    _blank = staticmethod(re.compile(rb"[ \t-\r]").search)

    def __init__(self, tokenizer: str):
        import os

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        if not os.path.exists(tokenizer):
            import public_tokenizers

            tokenizer = public_tokenizers.path(tokenizer)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_file(tokenizer)
        self._model = self._library.model
        # How the library shows each byte of plain words, of which two make a letter beyond ASCII.
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        table = {byte: chr(byte) for byte in range(256)}
        for letter in map(chr, range(0xC0, 0x100)):
            table.update(zip(letter.encode(), shown(letter)[0][0], strict=True))
        self._shown = "".join(table.values())
        self._forget()
        probe = self._PROBE.encode()
        self._by_word = True
        self._by_word = next(self.encode([probe])) == self._whole([probe])[0]

    def _forget(self) -> None:
        # The ids of the piece with number i are those from _ends[i] up to _ends[i + 1].
        self._numbers: dict[bytes, int] = {}
        self._ids, self._ends = array("I"), array("q", [0])
        self._held = 0

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self._library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def _learn(self, plain: list[bytes], odd: list[bytes]) -> None:
        """Number pieces of plain words and odd words that have no number yet."""
        # No piece holds a line end.
        shown = codecs.charmap_decode(b"\n".join(plain), "strict", self._shown)[0].split("\n") if plain else []
        tokenize = self._model.tokenize
        found = [[t.id for t in tokenize(piece)] for piece in shown]
        if odd:
            texts = [word.decode() for word in odd]
            found += [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]
        pieces = plain + odd
        self._numbers.update(zip(pieces, range(len(self._numbers), len(self._numbers) + len(pieces)), strict=True))
        self._ids.extend(chain.from_iterable(found))
        self._ends.extend(accumulate(map(len, found), initial=self._ends.pop()))
        self._held += sum(map(len, pieces)) + _KEPT_EACH * len(pieces)

    def _encode(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of UTF-8 that begins and ends with white space; where its pieces begin, and the ids before each and in all."""
        if self._held > _KEPT:
            self._forget()
        places, odd, text, bounds = _split(raw)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(text)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(places), buffers).dictionary_encode()
        different, which = _values(coded.dictionary), coded.indices.to_numpy()
        known = list(map(self._numbers.get, different))
        others = np.zeros(len(different), bool)
        others[which[odd]] = True
        new = [i for i, number in enumerate(known) if number is None]
        self._learn([different[i] for i in new if not others[i]], [different[i] for i in new if others[i]])
        for i in new:
            known[i] = self._numbers[different[i]]
        number = np.array(known, np.int64)[which]
        ends = np.frombuffer(self._ends, np.int64)
        begins, lengths = ends[number], ends[number + 1] - ends[number]
        before = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(begins - before[:-1], lengths) + np.arange(before[-1])
        return np.frombuffer(self._ids, np.uint32)[at].astype("<u4", copy=False), places, before

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Per text its ids as little-endian uint32."""
        if not self._by_word:
            yield from self._whole(texts)
            return
        data = b"\n".join([b"", *texts, b""])
        # Where the line end after each text stands.
        stops = np.cumsum([len(t) + 1 for t in texts])
        begin, last, done = 0, len(data) - 1, 0
        own: list[np.ndarray] = []
        while begin < last:
            end = self._blank(data, min(begin + _PART, last)).start()
            ids, places, before = self._encode(np.frombuffer(data, np.uint8, end + 1 - begin, begin))
            stopped = np.searchsorted(stops, end, "right")
            low = 0
            for high in before[np.searchsorted(places, stops[done:stopped] - begin)].tolist():
                own.append(ids[low:high])
                yield b"".join(own)
                own, low = [], high
            own.append(ids[low:])
            begin, done = end, stopped


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) per level."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest >> 8
        continues = more > 0
        bitmap = np.packbits(continues, bitorder="little")
        blocks = np.add.reduceat(continues, np.arange(0, len(rest), BLOCK), dtype=np.uint64)
        directory = np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks)])[:-1].astype("<u8")
        levels.append(((rest & 255).astype(np.uint8), bitmap, directory))
        rest = more[continues]
    return levels


def write_file(path: str, ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> None:
    """One file; ``path`` is a URI or a local path."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    footer = {"tokens": len(ids), "docs": len(doc_ids), "levels": []}
    with system.open_output_stream(name) as out:
        for parts in levels_of(ids):
            places = []
            for part in parts:
                places.append(out.tell())
                out.write(part.tobytes())
            footer["levels"].append({"at": places, "n": len(parts[0])})
        footer["ids_at"] = out.tell()
        out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        out.write(bytes(d is not None for d in doc_ids))
        footer["offsets_at"] = out.tell()
        out.write(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
        text = json.dumps(footer).encode()
        out.write(text + struct.pack("<I", len(text)) + MAGIC)


class TokenFile:
    """Reads one file: a single token, or a range of them."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        self._in = system.open_input_file(name)
        size = self._in.size()
        tail = self._in.read_at(len(MAGIC) + 4, size - len(MAGIC) - 4)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is no token file")
        length = struct.unpack("<I", tail[:4])[0]
        self.footer = json.loads(self._in.read_at(length, size - len(tail) - length))
        self.tokens, self.docs = self.footer["tokens"], self.footer["docs"]

    def close(self) -> None:
        self._in.close()

    def doc_ids(self) -> list[int | None]:
        at = self.footer["ids_at"]
        values = np.frombuffer(self._in.read_at(8 * self.docs, at), "<i8").tolist()
        valid = self._in.read_at(self.docs, at + 8 * self.docs)
        return [v if ok else None for v, ok in zip(values, valid, strict=True)]

    def offsets(self) -> np.ndarray:
        return np.frombuffer(self._in.read_at(8 * (self.docs + 1), self.footer["offsets_at"]), "<u8")

    def _rank(self, level: dict, place: int) -> int:
        """Set bits of the level's bitmap before ``place``."""
        _, bitmap_at, directory_at = level["at"]
        block = place // BLOCK
        before = struct.unpack("<Q", self._in.read_at(8, directory_at + 8 * block))[0]
        begin = block * BLOCK // 8
        part = int.from_bytes(self._in.read_at(place // 8 + 1 - begin, bitmap_at + begin), "little")
        return before + (part & ((1 << (place - block * BLOCK)) - 1)).bit_count()

    def token(self, place: int) -> int:
        """The token at ``place``, from at most four reads per level."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        value, shift = 0, 0
        for level in self.footer["levels"]:
            chunks_at, bitmap_at, _ = level["at"]
            value |= self._in.read_at(1, chunks_at + place)[0] << shift
            if not self._in.read_at(1, bitmap_at + place // 8)[0] >> place % 8 & 1:
                break
            place, shift = self._rank(level, place), shift + 8
        return value

    def range(self, begin: int, end: int) -> np.ndarray:
        """The tokens from ``begin`` up to ``end`` as uint32."""
        values = np.zeros(max(0, end - begin), "<u4")
        places, shift = np.arange(len(values)), 0
        for level in self.footer["levels"]:
            if begin >= end:
                break
            chunks_at, bitmap_at, _ = level["at"]
            chunks = np.frombuffer(self._in.read_at(end - begin, chunks_at + begin), np.uint8)
            values[places] |= chunks.astype("<u4") << shift
            low, high = begin // 8, (end + 7) // 8
            bits = np.unpackbits(
                np.frombuffer(self._in.read_at(high - low, bitmap_at + low), np.uint8), bitorder="little"
            )[begin - 8 * low : end - 8 * low]
            places = places[bits.astype(bool)]
            begin, shift = self._rank(level, begin), shift + 8
            end = begin + len(places)
        return values


def write_tokens(
    docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Write the ids of all ``docs`` to files; returns the manifest.

    It has ``file``, ``first_id``, ``first_hash``, ``number`` (of the file within its task),
    ``n_docs``, ``n_tokens`` and ``start``, the ids in all files before.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        encoder, end = WordEncoder(tokenizer), struct.pack("<I", end_id)
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        hashes: list[int] = []
        number, held = 0, 0

        def closed() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.dac"
            lengths = [len(x) // 4 for x in ids]
            write_file(path, np.frombuffer(b"".join(ids), "<u4"), doc_ids, lengths)
            row = [path, doc_ids[0], hashes[0], number, len(ids), sum(lengths)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _FILE, strict=True)], schema=_FILE)

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(sizes // _PART)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(i, j - i)
                texts = [t or b"" for t in part.column(2).cast(pa.binary()).to_pylist()]
                own = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), encoder.encode(texts), strict=True)
                for doc_id, key, words in own:
                    ids.append(words + end)
                    doc_ids.append(doc_id)
                    hashes.append(key)
                    held += len(ids[-1]) // 4
                    if held >= file_tokens:
                        yield closed()
                        ids, doc_ids, hashes, number, held = [], [], [], number + 1, 0
        if ids:
            yield closed()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
    )
    files = staged(
        ordered.mapInArrow(
            write, "file string, first_id long, first_hash long, number long, n_docs long, n_tokens long"
        ),
        "manifest",
    )
    # One row per file: the whole manifest is small.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "number", "file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


_FILE = pa.schema(
    [
        ("file", pa.string()),
        ("first_id", pa.int64()),
        ("first_hash", pa.int64()),
        ("number", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``."""
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = TokenFile(path)
                offsets = file.offsets().astype(np.int64)
                ends = offsets.tolist()
                # A file is of bounded size, so it is read from one end to the other.
                ids = file.range(0, file.tokens)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids(), pa.int64()),
                        pa.array(offsets[:-1] + start),
                        pa.array(np.diff(offsets)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                file.close()

    # Dealt out by file: rows are few, but each stands for a whole file.
    return (
        manifest.select("file", "start")
        .repartition(min(files, 8192))
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
