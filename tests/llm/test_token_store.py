import itertools
import random
import struct
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from studiolens.llm import catalog, token_store

TEXTS = [
    "Plain words, twice: plain WORDS.",
    "it's we'll <|endoftext|> <|STARTOFTEXT|> a<|startoftext|>b",
    "étÉ W̊ İstanbul Σσς １²",
    "no break line\x1cunit\x85next\x0btab\x0cfeed",
    "\x00\x01 \x7f 1234 56.78%%% *** \U0001f600 中文",
    "",
    "   ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(library):
    got = token_store.WordEncoder(token_store.TOKENIZER).encode([t.encode() for t in TEXTS])
    for text, ids in zip(TEXTS, got, strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == ids_of(library, text), text


def test_other_tokenizers_encode_whole_texts():
    encoder = token_store.WordEncoder("byte_bpe_50k.json")
    assert not encoder._by_word
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = next(encoder.encode([b"Two  words"]))
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == other.encode("Two  words", add_special_tokens=False).ids


def test_new_words_of_known_pieces_take_no_calls():
    encoder = token_store.WordEncoder(token_store.TOKENIZER)
    names = ["".join(p) for p in itertools.product("abé", repeat=3)]
    words = " ".join(f"{a.title()}7{b}." for a in names for b in names).encode()
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = list(encoder.encode([words]))
    finally:
        sys.setprofile(None)
    # 729 different words, but 29 different pieces.
    assert calls < 400
    assert got == encoder._whole([words])


@pytest.mark.parametrize(("part", "kept"), [(1, 0), (5, 10**9), (64, 3000), (1 << 22, 0)])
def test_parts_and_forgotten_pieces_change_no_ids(monkeypatch, part, kept):
    monkeypatch.setattr(token_store, "_PART", part)
    monkeypatch.setattr(token_store, "_KEPT", kept)
    encoder = token_store.WordEncoder(token_store.TOKENIZER)
    draw = random.Random(part)
    signs = [*"aZéÀßÿ×÷Þ19 \t\n\x0b\x1c\x85\xa0'’<|>.,-_\x7f\x00中"]
    signs += ["<|endoftext|>", "<|", "'ll", "e\u0301", "\u0301", "</w>", "  "]
    for _ in range(60):
        texts = ["".join(draw.choices(signs, k=draw.choice([0, 1, 20, 80]))).encode() for _ in range(draw.choice([1, 2, 9]))]
        assert list(encoder.encode(texts)) == encoder._whole(texts)
    assert list(encoder.encode([])) == []


def test_rows_are_cut_into_parts_by_their_bytes(spark, documents, library, monkeypatch):
    monkeypatch.setattr(token_store, "_PART", 16)
    rows = [(i, t) for i, t in enumerate([None, "", *TEXTS, "a long text of many words " * 9, None, "x", "y"])]
    got = token_store.read_documents(token_store.write_tokens(documents(*rows))).collect()
    want = {i: np.array([*ids_of(library, t), 1], "<u4") for i, t in rows}
    for r in got:
        assert (r.n_tokens, r.ids_crc32) == (len(want[r.doc_id]), zlib.crc32(want[r.doc_id].tobytes()))
    assert sorted(r.doc_id for r in got) == sorted(want)


@pytest.mark.parametrize("top", [1, 256, 70_000, 2**32])
def test_any_token_and_any_range(tmp_path, top):
    draw = random.Random(top)
    ids = np.array([draw.randrange(top) if draw.random() < 0.5 else draw.randrange(min(top, 9)) for _ in range(3000)], "<u4")
    path = f"{tmp_path}/x.dac"
    token_store.write_file(path, ids, [7, None], [1000, 2000])
    file = token_store.TokenFile(path)
    assert file.doc_ids() == [7, None]
    assert file.offsets().tolist() == [0, 1000, 3000]
    assert all(file.token(i) == ids[i] for i in [*draw.sample(range(3000), 300), 0, 2999])
    for _ in range(100):
        a, b = sorted(draw.sample(range(3001), 2))
        assert (file.range(a, b) == ids[a:b]).all()
    assert len(file.range(5, 5)) == 0
    with pytest.raises(IndexError):
        file.token(3000)


def test_round_trip(spark, documents, library):
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "first"), (3, None), (5, "same"), (5, "same"), (5, "other")]
    manifest = token_store.write_tokens(documents(*rows), file_tokens=20)
    assert manifest.count() > 1
    got = [tuple(r) for r in token_store.read_documents(manifest).orderBy("start").collect()]
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    want = {}
    for doc_id, text in rows:
        ids = np.array([*ids_of(library, text), 1], "<u4")
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    have, place = {}, 0
    for doc_id, start, n, crc in got:
        assert start == place
        place += n
        have.setdefault(doc_id, []).append((n, crc))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_whole_table(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    place = 0
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in catalog.op2_token_store(spark, sf_dir).collect()}
    for row in rows:
        ids = np.array([*ids_of(library, row.text), 1], "<u4")
        assert tuple(got[row.doc_id]) == (row.doc_id, place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)


def test_empty_table(documents):
    manifest = token_store.write_tokens(documents("x").limit(0))
    assert manifest.count() == 0
    assert token_store.read_documents(manifest).count() == 0
