import hashlib
import re

import pytest
from pyspark.sql import functions as F

from studiolens.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, window=10):
    own, hit, names = words(text), set(), set()
    for item, body in items:
        w = words(body)
        n = min(len(w), window)
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                names.add(str(item))
    listed = ",".join(sorted(names))
    return len(own), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def items():
    long = " ".join(f"q{i}" for i in range(25))
    return [(1, long), (2, "Short ONE"), (3, "single"), (4, "..."), (5, None), (10, long), (7, "a b c d e f g h i")]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_every_offset_and_length(documents, benchmark, items):
    texts = [None, "", "!!!", "it is single.", "short, one short one", "Q0 q1", "a b c d e f g h i", "x a b c d e f g h"]
    for lead in range(12):
        for take in (9, 10, 11, 17):
            begin = (lead * 3) % 8
            texts.append(" ".join([*["pad"] * lead, *[f"Q{i}" for i in range(begin, begin + take)], "end"]))
    texts += [texts[-1], "pad " * 20_000 + " ".join(f"q{i}" for i in range(10))]
    docs = documents(*texts).withColumn("n_hit", F.lit("old"))
    got = {r.doc_id: tuple(r[c] for c in decontaminate.ADDED) for r in decontaminate.with_hits(docs, benchmark).collect()}
    want = {i: plain(t, items) for i, t in enumerate(texts)}
    assert got == want
    kept = decontaminate.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if not w[-1]}


def test_spans_are_cut(documents, benchmark):
    docs = documents("Keep this, Short-One! and that", "all fine", None)
    out = decontaminate.without_spans(docs, benchmark).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["Keep this, -! and that", "all fine", None]


def test_repeated_ids_and_rows(documents, benchmark, items):
    rows = [(1, "single"), (1, "single"), (1, "clean"), (None, "short one"), (None, None)]
    got = sorted(tuple(r[c] for c in decontaminate.ADDED) for r in decontaminate.with_hits(documents(*rows), benchmark).collect())
    assert got == sorted(plain(t, items) for _, t in rows)


def test_empty_tables(documents, benchmark):
    none = documents("x").limit(0)
    assert decontaminate.with_hits(none, benchmark).count() == 0
    rows = decontaminate.with_hits(documents("single"), benchmark.limit(0)).collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in rows] == [(0, 0, False)]
    assert decontaminate.clean_documents(documents("single"), benchmark.limit(0)).count() == 1
