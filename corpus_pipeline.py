"""From raw documents to token files: the stages of a training-data pipeline.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns where each document's ids are in the token files. Empty tables
go through as empty tables; what each stage does with nulls and repeated rows is stated in its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.llm import decontaminate, language, mixing, simhash, token_store
from studiolens.llm.shared import read, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their labelled, not held-out rows teach."""
    return language.spoken(docs, docs.where(~language.held_out(F.col("doc_id"))))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link at four bits, the smallest doc_id."""
    return simhash.deduplicated(docs, words=4, bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of any benchmark item."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that their sources reach the target weights."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in files; per document its place and checksum in them."""
    return token_store.read_documents(token_store.write_tokens(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("mix", mixed_sources),
    ("tokens", token_files),
]

# Python encoders and learned models are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
