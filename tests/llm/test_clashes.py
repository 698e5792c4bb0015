"""Extra columns come back as they were, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from studiolens.llm import (
    decontaminate,
    language,
    mixing,
    near_vectors,
    personal,
    repeats,
    secret_scan,
    simhash,
    token_counts,
    token_store,
    url_filter,
)

NAMES = (
    "key h fp first component node class links cell home n a b src path state bucket size_ rule_ item phrase at"
    " words places term entity with_term key_ source_ url_ label_ short digest suffix level rank weight ratio vector"
    " i x value left right members choice part kept_ start end title"
).split() + ["a b", "x.y"]


def crowded(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in NAMES if c not in df.columns})


@pytest.fixture(scope="module")
def docs(documents):
    rows = [(i, f"text {i % 3} with words, mail me@site.org or item one two three", "en", "ab"[i % 2]) for i in range(6)]
    return crowded(documents(*rows, (7, None), (8, "word " * 9000)))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "item one two three")], "item_id long, text string")


OPERATORS = {
    "language": lambda d, b: language.with_language(d, d),
    "spoken": lambda d, b: language.spoken(d, d),
    "personal": lambda d, b: personal.with_spans(d),
    "sanitised": lambda d, b: personal.sanitised(d),
    "hits": lambda d, b: decontaminate.with_hits(d, b),
    "clean": lambda d, b: decontaminate.clean_documents(d, b),
    "spans": lambda d, b: decontaminate.without_spans(d, b),
    "repeats": lambda d, b: repeats.without_repeats(d),
    "mix": lambda d, b: mixing.mix(d),
    "counts": lambda d, b: token_counts.with_token_counts(d),
    "components": lambda d, b: simhash.with_components(d),
    "deduplicated": lambda d, b: simhash.deduplicated(d),
    "secrets": lambda d, b: secret_scan.with_secrets(d),
    "redacted": lambda d, b: secret_scan.redacted(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(docs, benchmark, name):
    rows = OPERATORS[name](docs, benchmark).collect()
    assert rows
    for row in rows:
        assert all(row[c] == f"own {c}" for c in NAMES)


def test_files_of_tokens(docs):
    assert token_store.read_documents(token_store.write_tokens(docs)).count() == docs.count()


def test_pages_and_vectors(spark):
    pages = crowded(spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string"))
    rules = url_filter.rule_table(spark, [("block", "org/")])
    (page,) = url_filter.judge(pages, rules).collect()
    assert all(page[c] == f"own {c}" for c in NAMES if c not in url_filter.ADDED)
    vectors = crowded(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 1), (3, None, None)], "vec_id long, embedding array<float>, label int"))
    rows = near_vectors.with_links(vectors).collect()
    assert len(rows) == 3
    assert all(row[c] == f"own {c}" for row in rows for c in NAMES)
