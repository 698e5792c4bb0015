import random

import pytest
from pyspark.sql import functions as F

from studiolens.llm import catalog, token_counts

TEXTS = ["", " ", "  two  blanks ", "<s> </s> <unk>", "▁marks ▁▁ in▁side", "tab\tline\nend ", "中文 \U0001f600 é", "a" * 500, " " * 300, "x ▁ y " * 40]


@pytest.fixture(scope="module")
def encoder():
    return token_counts.load(token_counts.MODEL)


def test_the_model_aligns(encoder):
    assert token_counts.aligns(encoder)


def spliced(encoder, text, chunk, overlap):
    """As the operator does it: the pieces' tokens less what is surplus at each seam."""
    total, sides = 0, {}
    for k, last, piece in token_counts.chunks_of(text, chunk, overlap):
        for seam, n, left, right in token_counts.seams_of(encoder, k, last, piece, chunk, overlap):
            total += n
            sides.setdefault(seam, []).append(right if left is None else left)
    extra = [token_counts.surplus(*pair) for pair in sides.values() if len(pair) == 2]
    return None if None in extra else total - sum(extra)


@pytest.mark.parametrize("chunk,overlap", [(3, 2), (10, 6), (64, 16), (200, 40)])
def test_chunks_add_up(encoder, chunk, overlap):
    draw = random.Random(chunk)
    some = ["the ", "ing", "über", "a", "b", " ", "\n", "é", "▁", "中文", "漢字かな", "ไทย", "e\u0301", "aaaa", "\U0001f600", "<s>", "0"]
    texts = TEXTS + ["".join(draw.choices(some, k=draw.randrange(1, 400))) for _ in range(150)]
    found = 0
    for text in texts:
        want = len(encoder.encode(text))
        assert token_counts.count_in_order(encoder, text, chunk, overlap) == want, text
        got = spliced(encoder, text, chunk, overlap)
        assert got in (None, want), text
        found += got is not None
    assert chunk < 64 or found > 0.9 * len(texts)


def test_texts_without_blanks_are_cut_into_pieces_of_one_size(encoder):
    draw = random.Random(1)
    text = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(300_000))
    pieces = [piece for _, _, piece in token_counts.chunks_of(text)]
    assert sum(map(len, pieces)) < 1.01 * len(text)
    assert spliced(encoder, text, token_counts.CHUNK, token_counts.OVERLAP) == len(encoder.encode(text))


def test_chunks_that_do_not_align_are_widened(encoder, monkeypatch):
    assert spliced(encoder, "a" * 1001, 101, 8) is None
    tried = []
    once = token_counts._in_order
    monkeypatch.setattr(token_counts, "_in_order", lambda *a: tried.append(a[2:]) or (once(*a) if a[2] > 101 else None))
    assert token_counts.count_in_order(encoder, "a" * 1001, 101, 8) == len(encoder.encode("a" * 1001))
    assert tried == [(101, 8), (202, 16)]


def test_operator(documents, encoder):
    huge = "some words and more of them, " * 3000
    unbroken = "z" * 70_001
    rows = [*TEXTS, None, huge, huge, unbroken, unbroken, huge + unbroken + huge, "漢字かな交じり文" * 9000]
    docs = documents(*rows).withColumn("n_bytes", F.lit("old"))
    got = token_counts.with_token_counts(docs, limit=100).orderBy("doc_id").collect()
    want = [len(encoder.encode(t or "")) for t in rows]
    assert [r.n_tokens for r in got] == want
    assert [r.n_bytes for r in got] == [len((t or "").encode()) for t in rows]
    assert [r.over_limit for r in got] == [n > 100 for n in want]
    assert token_counts.with_token_counts(documents("x").limit(0)).count() == 0


def test_whole_table(spark, sf_documents, encoder):
    got = {r.doc_id: r.n_tokens for r in catalog.op9_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: len(encoder.encode(r.text or "")) for r in sf_documents.collect()}
