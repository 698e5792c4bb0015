"""Phrases whose words occur together far more often than apart.

Words get ids in the order of their frequency, so pairs of frequent words lie in few square
tiles of the table of all pairs. A task counts the neighbours in a block of text: a tile that many of them hit by
a dense bincount, all others as sorted coordinates (row, column, count). Blocks are added up by a
sum per pair. Pairs that occur often enough are ranked by frequency anew and take the place of
words: neighbouring pairs overlap by a word and are phrases of three, neighbouring phrases of three are
phrases of four, each counted by the same function.

A block holds texts of one language, its words as numbers. What a block has counted meets the counts of all
others in one shuffle, and comes back to the block as the ids of the next
round, so no task ever holds the vocabulary. The most frequent pair has one row per block
there, a hot language is many blocks, and the best phrases of a language are first chosen in parts.

Defined cases: a null text holds no words; a null language counts as ``und``; repeated rows count each time; ties are
ordered by the phrase; an empty table gives no rows; a language without frequent phrases has none. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studiolens.llm.shared import staged

LEAST = 30
TOP = 2000
LONGEST = 4

# Side of a tile, and the pairs of a block that make it worth a dense table.
TILE = 1024
DENSE = TILE * TILE // 16
# Tiles are looked for among this many rows and columns of them: pairs beyond are rare by rank.
_TILES = 64

# Words that a task holds before it closes the block of the language with most of them.
HELD = 1_500_000

# Parts in which the best phrases of a language are first chosen.
_PARTS = 64

_SLICE = 1 << 20
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" ")


class _Words(dict):
    """Numbers words in the order in which they are first asked for; marks have numbers below 0."""

    def __init__(self) -> None:
        super().__init__({b"\n": -1, b"": -2})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 2
        return number


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a line end for each piece's end, and empty strings, in slices."""
    begin = 0
    while begin < len(text):
        end = min(begin + _SLICE, len(text))
        if end < len(text):
            cut = max(text.rfind(mark, begin, end) for mark in (b" ", b"\n", b"."))
            if cut < 0:
                found = [at for mark in (b" ", b"\n", b".") if (at := text.find(mark, end)) >= 0]
                cut = min(found, default=len(text) - 1)
            end = cut + 1
        yield text[begin:end].lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        begin = end


def _gaps_once(symbols: np.ndarray) -> np.ndarray:
    """``symbols`` with each run of -1 as a single one."""
    gap = symbols < 0
    return symbols[~(gap & np.concatenate([[True], gap[:-1]]))]


def _packed(symbols: np.ndarray) -> bytes:
    """A byte for the width, then the symbols."""
    kind = "<i4" if symbols.max(initial=0) < 1 << 31 else "<i8"
    return kind[2].encode() + symbols.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[:1].decode()}", offset=1)


def pair_counts(symbols: np.ndarray, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of neighbours (row, column) and how often each occurs.

    Tiles are of the ids that the block holds, in their order, which is that of frequency.
    """
    known = np.unique(symbols)
    own = np.searchsorted(known, symbols).astype(np.int32)
    x, y = own[:-1], own[1:]
    both = (symbols[:-1] >= 0) & (symbols[1:] >= 0)
    x, y = x[both], y[both]
    rows, columns, counts = [], [], []
    near = (x < _TILES * tile) & (y < _TILES * tile)
    place = np.full(len(x), _TILES * _TILES, np.int32)
    place[near] = x[near] // tile * _TILES + y[near] // tile
    sizes = np.bincount(place, minlength=_TILES * _TILES)[: _TILES * _TILES]
    sparse = np.ones(len(x), bool)
    for own in np.flatnonzero(sizes >= dense).tolist():
        inside = place == own
        sparse &= ~inside
        table = np.bincount(x[inside] % tile * tile + y[inside] % tile, minlength=tile * tile)
        cells = np.flatnonzero(table)
        rows.append(own // _TILES * tile + cells // tile)
        columns.append(own % _TILES * tile + cells % tile)
        counts.append(table[cells])
    x, y = x[sparse].astype(np.int64), y[sparse].astype(np.int64)
    del place, near, both
    x *= len(known)
    x += y
    x.sort()
    first = np.flatnonzero(np.diff(x, prepend=-1))
    x, y = np.divmod(x[first], max(1, len(known)))
    return (
        known[np.concatenate([*rows, x])],
        known[np.concatenate([*columns, y])],
        np.concatenate([*counts, np.diff(first, append=sparse.sum())]),
    )


# --- blocks ---------------------------------------------------------------------------


def _blocks(docs: DataFrame, held: int) -> DataFrame:
    """Texts as blocks of numbers: rows with the ``symbols`` of a block, and rows with its words.

    ``n`` is the number of words in the block, or of a word in it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        words: dict[str, _Words] = {}
        parts: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def closed(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            symbols = _gaps_once(np.concatenate(parts.pop(lang)))
            own, size = list(words.pop(lang))[2:], sizes.pop(lang)
            counts = np.bincount(symbols[symbols >= 0], minlength=len(own)).astype(np.int64)
            yield _rows(number, lang, [None], [None], [size], [_packed(symbols)])
            for i in range(0, len(own), 50_000):
                some = own[i : i + 50_000]
                yield _rows(number, lang, some, range(i, i + len(some)), counts[i : i + len(some)], [None] * len(some))
            number += 1

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                langs, texts = batch.slice(i, 256).columns
                for lang, text in zip(langs.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
                    if lang not in words:
                        words[lang], parts[lang], sizes[lang] = _Words(), [], 0
                    for tokens in _tokens(text or b""):
                        found = np.fromiter(map(words[lang].__getitem__, tokens), np.int32, len(tokens))
                        parts[lang].append(found[found > -2])
                        sizes[lang] += int((found >= 0).sum())
                    parts[lang].append(np.array([-1], np.int32))
                    while sum(sizes.values()) >= held:
                        yield from closed(max(sizes, key=sizes.__getitem__))
        for lang in list(words):
            yield from closed(lang)

    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "block bigint, lang string, word string, local bigint, n bigint, symbols binary")


def _rows(block: int, lang: str, words: list, local, counts, symbols: list) -> pa.RecordBatch:
    n = len(words)
    columns = [
        pa.array(np.full(n, block), pa.int64()),
        pa.array([lang] * n, pa.string()),
        pa.array(words, pa.binary()).cast(pa.string()),
        pa.array(list(local), pa.int64()),
        pa.array(counts, pa.int64()),
        pa.array(symbols, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "lang", "word", "local", "n", "symbols"])


def _pairs(sequences: DataFrame, tile: int, dense: int) -> DataFrame:
    """Pairs of neighbours of each block: block, x, y, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x, y, n = pair_counts(_unpacked(data.as_py()), tile, dense)
                for i in range(0, len(x), 100_000):
                    part = slice(i, i + 100_000)
                    columns = [np.full(len(x[part]), block), x[part], y[part], n[part].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["block", "x", "y", "n"])

    return sequences.select("block", "symbols").mapInArrow(count, "block bigint, x bigint, y bigint, n bigint")


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """``rows`` of words or pairs that occur ``least`` times in all blocks, with that number
    ``f`` and an ``id``; those of the same one are neighbours.

    Keys are dealt into buckets. A bucket ranks its own by frequency, and ids go round the buckets,
    so frequent ones have low ids and no task sees more than some buckets. One shuffle sums, ranks and
    tells the blocks: nothing is joined.
    """
    spread = 64 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(spread))
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy(F.col("f").desc(), *keys))
    return (
        rows.repartition(bucket)
        .withColumn("bucket", bucket)
        .withColumn("f", F.sum("n").over(Window.partitionBy("bucket", *keys)))
        .where(F.col("f") >= least)
        .withColumn("id", (place - 1).cast("bigint") * spread + F.col("bucket"))
        .drop("bucket", "n")
    )


def _told(pairs: DataFrame) -> DataFrame:
    """Frequent pairs once each (id, x, y, f), and for each block its own ones in one value (block, data)."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(columns: dict[str, list | np.ndarray]) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            fields = [("block", pa.int64()), ("data", pa.binary()), *[(c, pa.int64()) for c in ("id", "x", "y", "f")]]
            own = [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in fields]
            return pa.RecordBatch.from_arrays(own, [c for c, _ in fields])

        def flushed() -> pa.RecordBatch:
            block, *values = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            order = np.lexsort((values[1], values[0], block))
            block, values = block[order], [v[order] for v in values]
            first = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
            ends = [*first[1:].tolist(), len(block)]
            data = [_squeezed([v[a:b] for v in values]) for a, b in zip(first.tolist(), ends, strict=True)]
            return batch_of({"block": block[first], "data": data})

        held: list[list[np.ndarray]] = []
        last = -1
        for batch in batches:
            block, x, y, f, own = [c.to_numpy() for c in batch.columns]
            new = np.diff(own, prepend=last) != 0
            last = own[-1] if len(own) else last
            yield batch_of({"id": own[new], "x": x[new], "y": y[new], "f": f[new]})
            held.append([block, x, y, own])
            if sum(len(h[0]) for h in held) >= HELD:
                yield flushed()
        if sum(len(h[0]) for h in held):
            yield flushed()

    fields = "block bigint, data binary, id bigint, x bigint, y bigint, f bigint"
    return staged(pairs.select("block", "x", "y", "f", "id").mapInArrow(tell, fields), "told")


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """Integers of equal length, compressed; the first column is sorted."""
    first = np.diff(columns[0], prepend=0)
    planes = np.array([first, *columns[1:]], "<i8").view(np.uint8).reshape(-1, 8).T
    raw = np.ascontiguousarray(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unsqueezed(data: bytes, columns: int) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1).T
    table = np.ascontiguousarray(planes).view("<i8").reshape(columns, -1)
    return [np.cumsum(table[0]), *table[1:]]


def _renamed(sequences: DataFrame, names: DataFrame) -> DataFrame:
    """The sequences of the next round, from what ``names`` tells each block: the id of a word
    (``local``, ``id``), or those of its pairs (``data``)."""
    by_pair = "data" in names.columns

    def rename(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if by_pair:
            parts = [_unsqueezed(data, 3) for data in right.column("data").to_pylist()]
            columns = [np.concatenate([np.zeros(0, np.int64), *[p[i] for p in parts]]) for i in range(3)]
        else:
            columns = [right.column(c).to_numpy() for c in ("local", "id")]
        for data in left.column("symbols").to_pylist():
            symbols = _unpacked(data)
            ids = columns[-1].astype(np.int64)
            if not len(ids):
                continue
            if by_pair:
                ids = _looked_up(symbols, columns[0], columns[1], ids)
            else:
                # Place -1 of the table is that of the gaps.
                table = np.full(max(int(symbols.max(initial=0)), int(columns[0].max())) + 2, -1)
                table[columns[0]] = ids
                ids = table[symbols]
            ids = _gaps_once(ids)
            if len(ids) > 1:
                found.append(_packed(ids))
        blocks = pa.array([key[0].as_py()] * len(found), pa.int64())
        return pa.table([blocks, pa.array(found, pa.binary())], names=["block", "symbols"])

    left = sequences.select("block", "symbols").groupBy("block")
    return left.cogroup(names.groupBy("block")).applyInArrow(rename, "block bigint, symbols binary")


def _looked_up(symbols: np.ndarray, x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per place the id of the pair of it and the next one, -1 without one."""
    # Numbers of the block's own symbols are small enough for a code of two.
    known = np.unique(np.concatenate([x, y]))
    width = len(known)
    order = np.argsort(codes := np.searchsorted(known, x) * width + np.searchsorted(known, y))
    codes, ids = codes[order], ids[order]
    own = np.minimum(np.searchsorted(known, symbols), width - 1)
    there = known[own] == symbols
    wanted = own[:-1] * width + own[1:]
    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    hit = (codes[place] == wanted) & there[:-1] & there[1:]
    return np.where(hit, ids[place], -1)


# --- phrases --------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (left + right)), exactly."""
    wide = [c.cast("decimal(20,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * F.lit(2_000_000).cast("decimal(7,0)"), wide[1] + wide[2])


def _cut(a: Column, *cuts: tuple[Column, Column]) -> Column:
    """The lowest score of all cuts; the first one if several have it."""
    options = [
        F.struct(_score(a, left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
        for k, (left, right) in enumerate(cuts)
    ]
    return F.array_min(F.array(*options))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    held: int = HELD,
    tile: int = TILE,
    dense: int = DENSE,
) -> DataFrame:
    """The ``top`` phrases of two to four words per language: lang, rank, phrase, a, l, r, n, score.

    A phrase is a run of words within a piece of text, and occurs ``a`` times, ``least`` at
    least. Of its cuts into two parts that occur ``l`` and ``r`` times the one with the lowest score counts. A
    phrase with four fifths of its occurrences inside one longer phrase gives way to it.
    """
    blocks = staged(_blocks(docs, held), "blocks")
    sequences = blocks.where("symbols IS NOT NULL")
    words = blocks.where("word IS NOT NULL").select(F.col("block").alias("block"), "lang", "word", "local", "n")
    known = staged(_frequent(words, ["lang", "word"], least), "frequent")
    word = known.select("id", "lang", "word", "f").distinct()
    names = known.select(F.col("block").alias("block"), "local", "id")
    totals = sequences.groupBy("lang").agg(F.sum("n").alias("n"))

    tables = []
    for length in range(2, LONGEST + 1):
        sequences = staged(_renamed(sequences, names), "sequences")
        pairs = _pairs(sequences, tile, dense)
        if length < LONGEST:
            told = _told(_frequent(pairs, ["x", "y"], least))
            names = told.where("data IS NOT NULL").select("block", "data")
            tables.append(told.where("data IS NULL").select("id", "x", "y", "f"))
        else:
            counts = pairs.groupBy("x", "y").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
            tables.append(staged(counts, "phrases"))
    return _best(word, tables, totals, top)


def _best(word: DataFrame, tables: list[DataFrame], totals: DataFrame, top: int) -> DataFrame:
    """Phrases from the ids of their parts, judged."""

    def joined(table: DataFrame, parts: DataFrame) -> DataFrame:
        """Of both parts of each phrase all columns, with 1 and 2 after their names."""
        sides = [parts.select([F.col(c).alias(f"{c}{i}") for c in parts.columns]) for i in (1, 2)]
        both = table.join(sides[0], F.col("x") == F.col("id1")).join(sides[1], F.col("y") == F.col("id2"))
        # f0, the number of the phrase itself.
        return both.withColumnRenamed("f", "f0")

    c = F.col
    two = joined(tables[0], word).select(
        "id", c("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2").alias("phrase"), c("word2").alias("last"), c("f0").alias("f"),
        c("f1").alias("head"), c("f2").alias("tail"), _cut(c("f0"), (c("f1"), c("f2"))).alias("cut"),
    )
    # head, tail: the first and the last word; first, second: the first and the last pair.
    three = joined(tables[1], two).select(
        "id", c("lang1").alias("lang"), F.concat_ws(" ", "phrase1", "last2").alias("phrase"), c("last2").alias("last"), c("f0").alias("f"),
        c("head1").alias("head"), c("tail2").alias("tail"), c("f1").alias("first"), c("f2").alias("second"),
        _cut(c("f0"), (c("head1"), c("f2")), (c("f1"), c("tail2"))).alias("cut"),
    )
    four = joined(tables[2], three).select(
        c("lang1").alias("lang"), F.concat_ws(" ", "phrase1", "last2").alias("phrase"), c("f0").alias("f"),
        _cut(c("f0"), (c("head1"), c("f2")), (c("first1"), c("second2")), (c("f1"), c("tail2"))).alias("cut"),
    )

    def standing(shorter: DataFrame, longer: DataFrame) -> DataFrame:
        """Phrases without a longer one that holds them four times out of five.

        The most frequent of those that are longer by one word decides: any longer one occurs within it.
        """
        sides = [longer.select(c(side).alias("inside"), c("f").alias("over")) for side in ("x", "y")]
        over = sides[0].unionByName(sides[1]).groupBy("inside").agg(F.max("over").alias("over"))
        wide = [c(name).cast("decimal(20,0)") for name in ("over", "f")]
        most = F.coalesce(wide[0] * 100 < wide[1] * 80, F.lit(True))
        return shorter.join(over, c("id") == c("inside"), "left").where(most)

    columns = ["lang", "phrase", "f", "cut"]
    left = standing(two, tables[1]).select(*columns).unionByName(standing(three, tables[2]).select(*columns))
    found = left.unionByName(four.select(*columns))
    order = [c("cut.score").desc(), c("f").desc(), c("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    in_part = Window.partitionBy("lang", "part").orderBy(*order)
    chosen = found.withColumn("part", part).withColumn("place", F.row_number().over(in_part)).where(c("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return (
        chosen.withColumn("rank", rank)
        .where(c("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", c("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    )
