import pytest
from pyspark.sql import functions as F

from studiolens.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cap, share the excess again, until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        rest = sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: float(most * sizes[s]) for s in free if share[s] > most * sizes[s]}
        if not over:
            return {**capped, **share}
        capped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100},
        {"a": 1, "b": 1000, "c": 1000},
        {"a": 10, "b": 20, "c": 3, "d": 500, "é": 7, "z": 90, None: 40},
        {"a": 0, "b": 5},
        {f"s{i}": (i * 37) % 101 + 1 for i in range(40)},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, part) for s, n in sizes.items() for part in (n // 2, n - n // 2)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()
    assert {r.source: r.source_size for r in got} == sizes
    want = plain_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in got)


def test_copies_come_near_the_target(spark, documents):
    rows = [(i, "w " * (1 + i % 7), "en", "abc"[i * i % 3] if i % 11 else None) for i in range(3000)]
    docs = documents(*rows)
    table = mixing.with_copies(docs)
    per = table.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")
    )
    for r in per.collect():
        assert r.taken == pytest.approx(r.target, rel=0.1)
        assert r.most <= 3
    again = mixing.with_copies(docs.repartition(5))
    one, two = (sorted((r.doc_id, r.copies) for r in t.collect()) for t in (table, again))
    assert one == two
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(c for _, c in one)


def test_odd_rows(documents):
    docs = documents(
        (1, None, "en", "a"), (2, "", "en", None), (3, "\tone two\x0bthree four ", "en", "b"), (3, "\tone two\x0bthree four ", "en", "b"), (None, "x" * 200_000, "en", "b")
    ).withColumn("size", F.lit("old"))
    rows = mixing.with_copies(docs).collect()
    assert sorted(r.size for r in rows) == [0, 0, 1, 4, 4]
    assert {r.source: r.target for r in rows} == {"a": 0.0, None: 0.0, "b": 9.0}
    assert all(r.copies == 1 for r in rows if r.source == "b")
    assert all(r.copies == 0 for r in rows if r.source != "b")
    assert mixing.mix(docs).columns == docs.columns
    only = documents((1, None), (2, ""))
    assert {(r.target, r.copies) for r in mixing.with_copies(only).collect()} == {(0.0, 0)}
    assert mixing.mix(documents("x").limit(0)).count() == 0
