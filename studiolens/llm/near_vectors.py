"""Near copies among embeddings, exact within each label.

Equal vectors are one class from then on. Spherical k-means, fitted on a bounded sample, gives
centroids; each vector lives in the cell of its nearest centroid. It also visits every other cell
in which a vector close enough to link could live: such a vector lies on the far side
of the plane halfway between the two centroids, so the distance to that plane bounds how close it can be.
No link is lost. Within a cell, blocks of residents are multiplied with blocks of residents and
visitors; a block pair hands on one count per resident and the links that connect what is
close, never pairs. One vector of each component is kept.

On vectors without any structure the bound keeps most visits, and the work is that of an
exact comparison in blocks; on vectors that gather around centroids it is that within cells.
There are at most :data:`MOST_CELLS` cells, so beyond some 500,000 vectors of a label cells, and the
blocks each vector is sent to, grow with the data; the result does not depend on it.

Defined cases: a vector that is null, empty, zero, or holds a null or a number that is not
finite, and one without label, links with nothing and is its own component; vectors of different length do
not link; rows with equal vectors link with each other; one without vec_id links like any other, takes the component of
those it reaches, and has none (and is kept) if none of them has an id; ids are below 2**62; an empty table gives no rows. Columns of
the input but the vector are kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studiolens.llm.components import connected_components
from studiolens.llm.shared import staged

COSINE = 0.93
ADDED = ("n_links", "component_id", "kept")

# Vectors that the centroids are fitted on, at most, and vectors of a label per cell, about.
SAMPLE = 8192
CELL_ROWS = 2048
MOST_CELLS = 256

# Vectors in a block; two blocks are compared in one task.
BLOCK = 1024

_ROUNDS = 8

# Ids are below it.
_NO_ID = 1 << 62

# Added to the margin for rounding in the assignment; cosines themselves are compared as they are.
_SLACK = 1e-6


def fit(vectors: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids by spherical k-means; ``vectors`` are unit vectors."""
    centroids = vectors[np.random.default_rng(0).permutation(len(vectors))[:cells]]
    for _ in range(_ROUNDS):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    return np.unique(centroids, axis=0)


def cells_of(vectors: np.ndarray, centroids: np.ndarray, cosine: float) -> Iterator[tuple[int, int]]:
    """(index, cell) for each visit, the home cell first."""
    reach = np.sqrt(1 - cosine**2) + _SLACK
    near = vectors @ centroids.T
    home = near.argmax(axis=1)
    apart = np.linalg.norm(centroids[:, None, :] - centroids[None, :, :], axis=2)
    lead = near[np.arange(len(vectors)), home][:, None] - near
    visits = lead <= reach * apart[home]
    visits[np.arange(len(vectors)), home] = False
    for i, own in enumerate(home.tolist()):
        yield i, own
        for cell in np.flatnonzero(visits[i]).tolist():
            yield i, cell


def unit(rows: list[list[float]]) -> np.ndarray:
    table = np.array(rows, np.float64)
    table /= np.abs(table).max(axis=1, keepdims=True)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def connect(close: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and each column reaches through ``close``."""
    top = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(close, right[None, :], top).min(axis=1, initial=top))
        new_right = np.minimum(right, np.where(close, new_left[:, None], top).min(axis=0, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def compare(table: pa.Table, cosine: float) -> pa.Table:
    """Counts and links of one pair of blocks: residents against all."""
    size = len(table["unit"][0].as_py())
    vectors = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(-1, size // 8)
    ids, n = table["first"].to_numpy(), table["n"].to_numpy()
    is_left = table["left"].to_numpy(zero_copy_only=False)
    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    close = vectors[left] @ vectors[right].T >= cosine
    same = table["class"].to_numpy()[left][:, None] == table["class"].to_numpy()[right][None, :]
    counts = ((close & ~same) * n[right][None, :]).sum(axis=1)
    lower, other = connect(close | same, ids[left], ids[right])
    moved = np.flatnonzero(other != ids[right])
    return pa.table(
        {
            "class": np.concatenate([table["class"].to_numpy()[left], np.full(len(moved), -1)]),
            "links": np.concatenate([counts, np.zeros(len(moved), np.int64)]),
            "a": np.concatenate([ids[left], ids[right][moved]]),
            "b": np.concatenate([lower, other[moved]]),
        }
    )


def with_links(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Rows of ``vectors`` (``vec_id``, ``embedding``, ``label``) with :data:`ADDED`."""
    rows = vectors.drop(*ADDED).withColumn("__vec", F.col("embedding").cast("array<double>"))
    finite = F.forall("__vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("__vec", lambda x: x != 0)
    valid = F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False))
    grouped = (
        rows.where(valid)
        .groupBy("label", "__vec")
        .agg(F.min("vec_id").cast("long").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("class", F.monotonically_increasing_id())
    )
    # A class without any id links like the others, under a number after all ids.
    own = F.coalesce("first", F.lit(_NO_ID) + F.col("class"))
    classes = staged(grouped.withColumn("first", own), "vectors")

    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    cells = min(MOST_CELLS, -(-largest // CELL_ROWS))
    sample = classes.select("__vec").orderBy(F.xxhash64("__vec")).limit(SAMPLE).collect()
    by_size: dict[int, list[list[float]]] = {}
    for row in sample:
        by_size.setdefault(len(row[0]), []).append(row[0])
    centroids = {size: fit(unit(own), cells) for size, own in by_size.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0).to_pylist()
            own: dict[int, list[int]] = {}
            for i, vector in enumerate(lists):
                own.setdefault(len(vector), []).append(i)
            for size, chosen in own.items():
                units = unit([lists[i] for i in chosen])
                points = centroids.get(size, units[:1] * 0)  # a length not in the sample: one cell
                for at in range(0, len(units), 1024):
                    part = units[at : at + 1024]
                    visits = list(cells_of(part, points, cosine))
                    take = [chosen[at + i] for i, _ in visits]
                    homes = [k == 0 or visits[k - 1][0] != v[0] for k, v in enumerate(visits)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(1).take(pa.array(take)),
                            pa.array([size] * len(visits), pa.int32()),
                            pa.array([cell for _, cell in visits], pa.int32()),
                            pa.array(homes),
                            *(batch.column(c).take(pa.array(take)) for c in (2, 3, 4)),
                            pa.array([part[i].tobytes() for i, _ in visits], pa.binary()),
                        ],
                        ["label", "size", "cell", "home", "class", "first", "n", "unit"],
                    )

    label = dict(classes.dtypes)["label"]
    keys = ["label", "size", "cell"]
    placed = staged(
        classes.select("__vec", "label", "class", "first", "n").mapInArrow(
            assign, f"label {label}, size int, cell int, home boolean, class long, first long, n long, unit binary"
        ),
        "cells",
    )
    sizes = placed.groupBy(*keys).agg(
        F.ceil(F.count_if("home") / block).cast("int").alias("lefts"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rights"),
    )
    # Cells nobody lives in have no residents to compare; a visitor there meets nobody.
    counted = placed.join(sizes.where("lefts > 0"), keys)
    spread = F.xxhash64("class")
    lefts = (
        counted.where("home")
        .withColumn("l", F.pmod(spread, "lefts"))
        .withColumn("r", F.explode(F.expr("sequence(0L, rights - 1L)")))
        .withColumn("left", F.lit(True))
    )
    rights = (
        counted.withColumn("l", F.explode(F.expr("sequence(0L, lefts - 1L)")))
        .withColumn("r", F.pmod(spread, "rights"))
        .withColumn("left", F.lit(False))
    )
    columns = [*keys, "l", "r", "left", "class", "first", "n", "unit"]

    def compare_blocks(table: pa.Table) -> pa.Table:
        both = table["left"].to_pylist()
        if all(both) or not any(both):
            empty = pa.array([], pa.int64())
            return pa.table({"class": empty, "links": empty, "a": empty, "b": empty})
        return compare(table, cosine)

    compared = staged(
        lefts.select(columns)
        .unionByName(rights.select(columns))
        .groupBy(*keys, "l", "r")
        .applyInArrow(compare_blocks, "class long, links long, a long, b long"),
        "compared",
    )
    links = compared.where("class >= 0").groupBy("class").agg(F.sum("links").alias("links"))
    component = connected_components(compared.select("a", "b"))
    found = (
        classes.join(links, "class", "left")
        .join(component, F.col("first") == F.col("node"), "left")
        .select(
            F.col("label").alias("__label"),
            F.col("__vec").alias("__vec_"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    match = (F.col("label") == F.col("__label")) & (F.col("__vec") == F.col("__vec_"))
    return (
        rows.join(found, match, "left")
        .drop("__label", "__vec_", "__vec", "embedding")
        .withColumns(
            {
                "n_links": F.coalesce("n_links", F.lit(0)).cast("long"),
                "component_id": F.coalesce(F.when(F.col("component_id") < _NO_ID, F.col("component_id")), "vec_id"),
            }
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
