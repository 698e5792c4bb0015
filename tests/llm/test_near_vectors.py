import numpy as np
import pytest
from pyspark.sql import functions as F

from studiolens.llm import catalog, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.93):
    ids, vectors, labels = zip(*rows, strict=True)
    near = [[i] for i in range(len(ids))]
    for i, (v, a) in enumerate(zip(vectors, labels, strict=True)):
        for j, (w, b) in enumerate(zip(vectors, labels, strict=True)):
            if i == j or a is None or a != b or not v or not w or len(v) != len(w):
                continue
            if any(x is None or not np.isfinite(x) for x in [*v, *w]) or not any(v) or not any(w):
                continue
            x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                near[i].append(j)
    first = list(ids)
    while True:
        lower = [min(first[j] for j in n) for n in near]
        if lower == first:
            break
        first = lower
    return sorted((i, len(n) - 1, f, i == f) for i, n, f in zip(ids, near, first, strict=True))


def found(df):
    return sorted(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


@pytest.mark.parametrize("cell_rows,block", [(2048, 1024), (20, 7)])
def test_clusters_and_noise(spark, monkeypatch, cell_rows, block):
    draw = np.random.default_rng(1)
    rows = []
    for c in range(8):
        centre = draw.normal(size=16)
        for _ in range(20):
            spread = draw.uniform(0, 0.6)
            rows.append((len(rows), [float(x) for x in centre + spread * draw.normal(size=16)], c % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    monkeypatch.setattr(near_vectors, "CELL_ROWS", cell_rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(near_vectors.with_links(df, block=block)) == plain(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
        (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.0], 2),
        (12, [1.0, 0.0, 0.0], 1), (13, [1e-38, 0.0], 1), (14, [3e38, 1e38], 1), (15, [-0.0, 1.0], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("old"))
    assert found(near_vectors.with_links(df)) == plain(rows)


def test_empty_table(spark):
    assert near_vectors.with_links(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(catalog.op5_near_vectors(spark, sf_dir)) == plain(rows)


def test_vectors_without_id_keep_their_links(spark):
    """They link others and are linked, but name no component."""
    rows = [(None, [1.0, 0.01], 0), (1, [1.0, 0.0], 0), (None, [0.0, 1.0], 0), (None, [0.0, 1.0], 0), (2, [1.0, 0.3], 0), (5, [1.0, 0.55], 0)]
    got = near_vectors.with_links(spark.createDataFrame(rows, SCHEMA)).collect()
    own = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in got if r.component_id is not None)
    assert own == [(0, 2, 1, False), (1, 2, 1, True), (2, 3, 1, False), (5, 1, 1, False)]
    assert [(r.vec_id, r.n_links, r.kept) for r in got if r.component_id is None] == [(None, 1, True)] * 2
