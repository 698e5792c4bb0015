"""The stages of the pipeline against brute force, on planted cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import plain as plain_hits
from test_mixing import plain_targets
from test_simhash import plain_components, plain_print
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    draw = random.Random(4)
    vocabulary = {"en": "the cat sat on a mat with this hat".split(), "fr": "le chat est sur la table avec un chapeau".split()}
    item = " ".join(f"item{i}" for i in range(20))
    rows = []
    for i in range(60):
        lang = draw.choice(["en", "fr"])
        text = " ".join(draw.choice(vocabulary[lang]) for _ in range(draw.randrange(20, 200)))
        rows.append((i, text, lang, draw.choice(["a", "b", None])))
    rows += [(100 + i, rows[i][1], rows[i][2], "a") for i in range(8)]  # exact copies
    rows += [(200 + i, rows[i][1] + " end", rows[i][2], "b") for i in range(8)]  # near copies
    rows += [(300 + i, f"the cat {item} sat {i}", "en", "a") for i in range(3)]
    rows += [(400, None, "en", "a"), (401, "", "fr", None), (402, "123 456", "en", "b"), (0, rows[0][1], "en", "a")]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(*rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    for number, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name != "tokens":
            assert docs.columns == COLUMNS
        after = [tuple(r) for r in docs.collect()]
        CHECKS[name](before, after)
        before = after
    assert sorted(tuple(r) for r in pipeline.run(spark, folder).collect()) == sorted(before)


def check_language(before, after):
    assert sorted(after) == sorted(r for r in before if r[1] and any(c.isalpha() for c in r[1]))


def check_copies(before, after):
    rows = sorted(set(before))
    first = plain_components([plain_print(r[1], 4) for r in rows], 4)
    assert sorted(after) == [rows[i] for i in sorted(set(first))]
    assert not {r[0] for r in after} & set(range(100, 108))


def check_benchmark(before, after):
    items = [(1, " ".join(f"item{i}" for i in range(20)))]
    assert sorted(after) == sorted(r for r in before if not plain_hits(r[1], items)[-1])
    assert len(after) < len(before)


def check_mix(before, after):
    assert set(after) <= set(before)
    assert max(after.count(r) for r in set(after)) <= 3
    sizes, taken = {}, {}
    for table, rows in ((sizes, before), (taken, after)):
        for r in rows:
            table[r[3]] = table.get(r[3], 0) + len(r[1].split())
    for source, target in plain_targets(sizes).items():
        assert taken[source] == pytest.approx(target, rel=0.5)


def check_tokens(before, after):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    place, want = 0, []
    for row in sorted(before):
        ids = np.array([*library.encode(row[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((row[0], place, len(ids), zlib.crc32(ids.tobytes())))
        place += len(ids)
    assert sorted(after, key=lambda r: r[1]) == want


CHECKS = {
    "language": check_language,
    "near_copies": check_copies,
    "benchmark": check_benchmark,
    "mix": check_mix,
    "tokens": check_tokens,
}


def test_empty_tables(spark, folder, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
