"""Remove long byte strings that occur more than once.

The places are those of a difference cover, a perfect difference set modulo 133: for any two places i
and j there is one distance below 133 at which both i and j plus the distance are sampled, with
a twelfth of the names a cover modulo 3 would need. What follows is not the sort of triples with its
recursion: no order of suffixes is built, and no names are made from names. Only strings of ``LENGTH`` bytes
have to be told apart, so three steps give hashes to strings at these places, sort the hashes
and compare neighbours for equality; bytes themselves are not compared:

1. Equal texts are found by their digest; but for one of each, copies take no part in the rest.
2. Sampled places get the name of their next 68 bytes. If a 200-byte string occurs twice, then at some
   distance below 133 both occurrences have a sampled place, and these two have equal names.
3. For each sampled place with a repeated name and each quarter of the distances, two names: of the bytes that
   all 200-byte strings at these distances share, and of all bytes they cover. If the latter is
   repeated, so are all these strings. Where only the former is, the strings differ around it,
   and one place of each kind goes on to the last step.
4. The 200-byte strings left get names themselves.

Texts do not move. They are written once, and each task works on one file of them. What is
shuffled are names, a few bytes each and once per file, to buckets of bounded size where they are
sorted; what comes back is three bits for each. What a step has found is written per file. A name that a third of all documents hold is one name per file. Names that only narrow the
search have 48 bits; those that decide have 96.

Defined cases: a null or empty text has no bytes and nothing is removed; texts under ``LENGTH``
bytes are kept; repeated rows are copies of each other and removed whole, all of them; an
empty table gives no rows. What is kept may end within a character, so it is binary. Columns of the
input are kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from studiolens.llm.shared import staged
from studiolens.session import work_dir

LENGTH = 200
ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256")

# A perfect difference set. Each residue but 0 is a difference of two in one way.
PERIOD = 133
COVER = (0, 1, 3, 17, 21, 58, 65, 73, 100, 105, 111, 124)

# Distances from a string's begin to its sampled place, in ranges (first, last).
_RANGES = ((0, 33), (34, 67), (68, 101), (102, 132))

# Bytes of names that narrow the search, and of names that decide.
_NARROW, _DECIDE = 6, 12

# Names that meet in one bucket, about, and rows in a file of texts.
BUCKET_NAMES = 2_000_000
FILE_ROWS = 5_000


def _table(names: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(names), np.uint8).reshape(-1, width)


def _columns(names: np.ndarray) -> list[np.ndarray]:
    """Names as unsigned integers of up to eight bytes, the first bytes first."""
    columns = []
    for at in range(0, names.shape[1], 8):
        part = names[:, at : at + 8]
        wide = np.zeros((len(names), 8), np.uint8)
        wide[:, : part.shape[1]] = part
        columns.append(wide.view(">u8").ravel().astype(np.uint64))
    return columns


def _order(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order, and whether a name in it differs from the one before."""
    columns = _columns(names)
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), bool)
    for k, column in enumerate(columns):
        moved = column[order]
        differs = moved[1:] != moved[:-1]
        new[1:] = differs if k == 0 else new[1:] | differs
    return order, new


class Names:
    """The names of one file in one step, each once, in sorted order."""

    def __init__(self, names: np.ndarray):
        order, new = _order(names)
        self.first = order[new]
        self.unique = names[self.first]
        self.number = np.empty(len(names), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.often = np.bincount(self.number, minlength=len(self.unique)) > 1

    def slices(self, buckets: int) -> Iterator[tuple[int, slice]]:
        """Bucket numbers, by the first four bytes, and the names in them."""
        if len(self.unique):
            head = self.unique[:, :4].copy().view(">u4").ravel().astype(np.uint64)
            bucket = (head * np.uint64(buckets)) >> np.uint64(32)
            begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
            for begin, end in zip(begins, [*begins[1:], len(bucket)], strict=True):
                yield int(bucket[begin]), slice(begin, end)

    def flags(self, replies: list[Row] | list[dict], buckets: int) -> np.ndarray:
        """Per place: held elsewhere or twice here; one among different ones; the one to go on."""
        found = {r["bucket"]: r["bits"] for r in replies}
        bits = np.zeros((len(self.unique), 3), bool)
        for bucket, part in self.slices(buckets):
            n = part.stop - part.start
            bits[part] = np.unpackbits(np.frombuffer(found[bucket], np.uint8), count=3 * n).reshape(n, 3)
        own = bits[self.number]
        own[:, 0] |= self.often[self.number]
        is_first = np.zeros(len(self.number), bool)
        is_first[self.first] = True
        own[:, 2] &= is_first
        return own


def sort_bucket(rows: pa.Table, width: int, shared: int) -> pa.Table:
    """Replies to the files whose names met in a bucket; names begin with ``shared`` bytes of a wider kind."""
    blobs = [b.as_buffer() for b in rows["names"]]
    sources = rows["src"].to_numpy()
    sizes = np.array([len(b) // width for b in blobs])
    names = _table([bytes(b) for b in blobs], width)
    owner = np.repeat(np.argsort(np.argsort(sources)), sizes)
    # Files in the order of their ids, so that the first of equal names is that of the smallest.
    by_owner = np.argsort(owner, kind="stable")
    order, new = _order(names[by_owner])
    order = by_owner[order]
    number = np.cumsum(new) - 1
    bits = np.zeros((len(names), 3), bool)
    bits[order, 0] = np.bincount(number)[number] > 1
    bits[order, 2] = new
    if shared < width:
        kinds = _columns(names[order][:, :shared])[0]
        fresh = np.concatenate([[True], kinds[1:] != kinds[:-1]])
        group = np.cumsum(fresh) - 1
        bits[order, 1] = np.bincount(group, weights=new)[group] > 1
    ends = np.cumsum(sizes)
    replies = [np.packbits(bits[e - n : e].ravel()).tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    return pa.table({"src": rows["src"], "bucket": rows["bucket"], "bits": pa.array(replies, pa.binary())})


def _sorter(width: int, shared: int) -> Callable[[pa.Table], pa.Table]:
    def meet(rows: pa.Table) -> pa.Table:
        return sort_bucket(rows, width, shared)

    return meet


def read_file(path: str, columns: list[str] | None = None) -> pa.Table:
    import pyarrow.parquet as pq
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        return pq.read_table(file, columns=columns)


def runs(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The union of the ranges ``low`` to ``high``, as ranges that do not touch."""
    if not len(low):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    breaks = np.flatnonzero(low[1:] > reach[:-1] + 1)
    return np.stack([low[np.concatenate([[0], breaks + 1])], reach[np.concatenate([breaks, [len(low) - 1]])]], axis=1)


def _spread(ranges: np.ndarray) -> np.ndarray:
    """All numbers in the ranges."""
    return np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b + 1) for a, b in ranges.tolist()]])


class Step:
    """One step over the texts of a file: the names to send, and what their flags tell."""

    def __init__(self, texts: list[bytes], state: dict):
        """``state`` is what the steps before have found."""

    names: Names

    def found(self, flags: np.ndarray) -> dict:
        raise NotImplementedError


class Whole(Step):
    """Which texts are copies, and which of them take part."""

    def __init__(self, texts, state):
        import xxhash

        self._long = np.array([i for i, t in enumerate(texts) if len(t) >= LENGTH], np.int64)
        digests = [xxhash.xxh3_128_digest(texts[i])[:_DECIDE] for i in self._long.tolist()]
        self.names = Names(_table(digests, _DECIDE))

    def found(self, flags):
        return {"copies": self._long[flags[:, 0]], "active": self._long[flags[:, 2]]}


class Sampled(Step):
    """The sampled places whose next bytes occur elsewhere, per text."""

    def __init__(self, texts, state):
        import xxhash

        width, digest = LENGTH - PERIOD + 1, xxhash.xxh3_64_digest
        self._copies, self._places, names = state["copies"], [], []
        for i in state["active"].tolist():
            text = texts[i]
            grid = (np.arange(0, len(text), PERIOD)[:, None] + np.array(COVER)[None, :]).ravel()
            grid = grid[grid <= len(text) - width]
            self._places.append((i, grid))
            names.append(b"".join([digest(text[p : p + width])[:_NARROW] for p in grid.tolist()]))
        self.names = Names(_table(names, _NARROW))

    def found(self, flags):
        ends = np.cumsum([len(p) for _, p in self._places]).tolist()
        repeated = [(i, p[flags[e - len(p) : e, 0]]) for (i, p), e in zip(self._places, ends, strict=True)]
        return {"copies": self._copies, "sampled": [(i, p.astype(np.int32)) for i, p in repeated if len(p)]}


class Ranges(Step):
    """Where strings begin that are repeated for sure, and those to ask for, per text."""

    def __init__(self, texts, state):
        import xxhash

        narrow, decide = xxhash.xxh3_64_digest, xxhash.xxh3_128_digest
        near, far = (np.array(x) for x in zip(*_RANGES, strict=True))
        self._copies, self._spans, names = state["copies"], [], []
        for i, places in state["sampled"]:
            text, last = texts[i], len(texts[i]) - LENGTH
            place = places.astype(np.int64)[:, None]
            low, high = np.maximum(place - far, 0), np.minimum(place - near, last)
            some = low <= high
            self._spans.append((i, low[some], high[some]))
            shared = zip((place - near)[some].tolist(), (place - far + LENGTH)[some].tolist(), np.broadcast_to(near, some.shape)[some].tolist(), strict=True)
            # Where a text begins or ends within the range, that is part of the name.
            clip = ((place - low) << 8 | (place - high))[some]
            covered = zip(low[some].tolist(), (high[some] + LENGTH).tolist(), clip.tolist(), strict=True)
            names.append(
                b"".join(
                    [
                        narrow(text[a:b], k)[:_NARROW] + decide(text[c:d], m)[:_DECIDE]
                        for (a, b, k), (c, d, m) in zip(shared, covered, strict=True)
                    ]
                )
            )
        self.names = Names(_table(names, _NARROW + _DECIDE))

    def found(self, flags):
        sure, ask, at = {}, {}, 0
        for i, low, high in self._spans:
            own = flags[at : at + len(low)]
            at += len(low)
            for kind, chosen in ((sure, own[:, 0]), (ask, own[:, 1] & own[:, 2])):
                if chosen.any():
                    kind[i] = runs(low[chosen], high[chosen])
        return {"copies": self._copies, "sure": sure, "ask": ask}


class Strings(Step):
    """Where repeated strings begin, per text."""

    def __init__(self, texts, state):
        import xxhash

        digest = xxhash.xxh3_128_digest
        self._state, self._places, names = state, [], []
        for i, ranges in state["ask"].items():
            text, places = texts[i], _spread(ranges)
            self._places.append((i, places))
            names.append(b"".join([digest(text[p : p + LENGTH])[:_DECIDE] for p in places.tolist()]))
        self.names = Names(_table(names, _DECIDE))

    def found(self, flags):
        starts, at = dict(self._state["sure"]), 0
        for i, places in self._places:
            own = places[flags[at : at + len(places), 0]]
            at += len(places)
            if len(own):
                both = np.concatenate([starts.get(i, np.zeros((0, 2), np.int64)), np.stack([own, own], axis=1)])
                starts[i] = runs(both[:, 0], both[:, 1])
        return {"copies": self._state["copies"], "starts": starts}


def kept_parts(text: bytes, is_copy: bool, starts: np.ndarray | None) -> tuple[list[bytes], int]:
    """The parts of a text that stay, and the number of runs taken out."""
    if is_copy:
        return [], 1
    if starts is None:
        return [text], 0
    gone = runs(starts[:, 0], starts[:, 1] + LENGTH - 1)
    begins, ends = gone[:, 0].tolist(), (gone[:, 1] + 1).tolist()
    return [text[a:b] for a, b in zip([0, *ends], [*begins, len(text)], strict=True)], len(begins)


# Per step: bytes of a name, and of them those of the wider kind it belongs to.
_STEPS: tuple[tuple[type[Step], int, int], ...] = (
    (Whole, _DECIDE, _DECIDE),
    (Sampled, _NARROW, _NARROW),
    (Ranges, _NARROW + _DECIDE, _NARROW),
    (Strings, _DECIDE, _DECIDE),
)


def _binary(column: pa.ChunkedArray) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _row(values: list, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def without_repeats(docs: DataFrame, keep_bytes: bool = False, bucket_names: int = BUCKET_NAMES) -> DataFrame:
    """``docs`` without its text, with :data:`ADDED`, and ``kept`` (binary) if ``keep_bytes``."""
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    folder = work_dir(spark, "texts")
    docs.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
    texts = spark.read.schema(docs.schema).parquet(folder)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size * len(COVER) // PERIOD // bucket_names
    files = texts.select(F.input_file_name().alias("path")).distinct()
    nothing = F.lit(pickle.dumps({})).cast("binary")
    state = staged(files.select("path", F.xxhash64("path").alias("src"), nothing.alias("state")), "files")
    tasks = max(1, min(state.count(), 100_000))

    def prepared(step: type[Step], row: dict) -> Step:
        return step(_binary(read_file(row["path"], ["text"])["text"]), pickle.loads(row["state"]))

    for step, width, shared in _STEPS:

        def send(batches: Iterator[pa.RecordBatch], step=step) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int32(), pa.binary()]
            for batch in batches:
                for row in batch.to_pylist():
                    names = prepared(step, row).names
                    for bucket, part in names.slices(buckets):
                        sent = [row["src"], bucket, names.unique[part].tobytes()]
                        yield _row(sent, kinds, ["src", "bucket", "names"])

        def resolve(batches: Iterator[pa.RecordBatch], step=step) -> Iterator[pa.RecordBatch]:
            kinds = [pa.string(), pa.int64(), pa.binary()]
            for batch in batches:
                for row in batch.to_pylist():
                    own = prepared(step, row)
                    found = own.found(own.names.flags(row["replies"] or [], buckets))
                    yield _row([row["path"], row["src"], pickle.dumps(found)], kinds, ["path", "src", "state"])

        replies = (
            state.repartition(tasks)
            .mapInArrow(send, "src long, bucket int, names binary")
            .groupBy("bucket")
            .applyInArrow(_sorter(width, shared), "src long, bucket int, bits binary")
            .groupBy("src")
            .agg(F.collect_list(F.struct("bucket", "bits")).alias("replies"))
        )
        # One row per file on either side; replies are bits, but there are many.
        answered = state.join(replies.hint("merge"), "src", "left").repartition(tasks)
        state = staged(answered.mapInArrow(resolve, "path string, src long, state binary"), "state")

    columns = [c for c in docs.columns if c != "text"]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    kinds += ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", *(["kept binary"] if keep_bytes else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, table = pickle.loads(row["state"]), read_file(row["path"])
                copies, bodies = set(found["copies"].tolist()), _binary(table["text"])
                for at in range(0, len(bodies), 1000):
                    part = range(at, min(at + 1000, len(bodies)))
                    left = [kept_parts(bodies[i], i in copies, found["starts"].get(i)) for i in part]
                    whole = [len(bodies[i]) for i in part]
                    rest = [b"".join(pieces) for pieces, _ in left]
                    added = [
                        pa.array(whole, pa.int64()),
                        pa.array([n - len(r) for n, r in zip(whole, rest, strict=True)], pa.int64()),
                        pa.array([n for _, n in left], pa.int64()),
                        pa.array([hashlib.sha256(r).hexdigest() for r in rest]),
                        *([pa.array(rest, pa.binary())] if keep_bytes else []),
                    ]
                    names = [*columns, *ADDED, *(["kept"] if keep_bytes else [])]
                    others = [table[c].slice(at, len(part)).combine_chunks() for c in columns]
                    yield pa.RecordBatch.from_arrays([*others, *added], names)

    return state.repartition(tasks).mapInArrow(cut, ", ".join(kinds))
