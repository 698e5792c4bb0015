"""Phrases against a plain count of all runs of words; the whole table against SQL in test_sql."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from studiolens.llm import collocations


def plain(docs, least, top):
    counts, totals = {}, Counter()
    for lang, text in docs:
        own = counts.setdefault(lang or "und", Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for phrase, a in candidates.items():
            cuts = [(2_000_000 * a // (own[phrase[:k]] + own[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            longer = [
                f
                for other, f in candidates.items()
                if len(other) > len(phrase) and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
            ]
            if not any(100 * f >= 80 * a for f in longer):
                rows.append((-score, -a, " ".join(phrase).encode(), own[phrase[:k]], own[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def result(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    words = [f"w{i}" for i in range(12)] + ["É", "a\x1cb", "new", "york", "City"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(draw.randrange(0, 60)):
            parts.append(draw.choice(words))
            if draw.random() < 0.2:
                parts.append("New York City is")
            parts.append(draw.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "! "]))
        rows.append((draw.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    rows += [("en", "one two three four five. " * 3)] * 12 + [("fr", None), (None, None), ("fr", "")]
    rows += [("en", "go go go go go")] * 9
    return rows


@pytest.mark.parametrize(("least", "top", "held", "tile", "dense"), [(30, 2000, 10**6, 1024, 65_536), (4, 25, 300, 2, 3), (9, 7, 40, 1, 1)])
def test_all_runs_of_words(documents, rows, least, top, held, tile, dense):
    docs = documents(*[(i, text, lang, "a") for i, (lang, text) in enumerate(rows)])
    found = collocations.collocations(docs.withColumnRenamed("source", "word"), least, top, held, tile, dense)
    want = plain(rows, least, top)
    assert want
    assert result(found) == want


def test_empty_table(documents):
    assert result(collocations.collocations(documents((1, "a b")).limit(0))) == []
    assert result(collocations.collocations(documents((1, None), (2, "a b")))) == []


@pytest.mark.parametrize("far", [0, 1 << 20, 1 << 40, 1 << 61])
@pytest.mark.parametrize("tile", [1, 4, 1024])
def test_pairs_of_a_block(far, tile):
    """Dense tiles and sorted coordinates together hold each pair once."""
    draw = np.random.default_rng(far % 97 + tile)
    symbols = draw.integers(-2, 20, 3000)
    symbols = np.where(symbols < 0, -1, np.where(draw.random(3000) < 0.2, symbols + far, symbols))
    x, y, n = collocations.pair_counts(symbols, tile, 20)
    want = Counter((a, b) for a, b in zip(symbols.tolist(), symbols[1:].tolist(), strict=False) if a >= 0 and b >= 0)
    assert dict(zip(zip(x.tolist(), y.tolist(), strict=True), n.tolist(), strict=True)) == want
    assert (collocations._unpacked(collocations._packed(symbols)) == symbols).all()


def test_slices_of_a_text(monkeypatch):
    """Cutting a text into slices splits no word and joins no pieces."""
    draw = random.Random(3)
    for size in (1, 2, 5, 50):
        monkeypatch.setattr(collocations, "_SLICE", size)
        for _ in range(50):
            text = "".join(draw.choice("ab .\n\t,é") for _ in range(80)).encode()
            tokens = [t for part in collocations._tokens(text) for t in part if t]
            pieces = " ".join(t.decode() for t in tokens).split("\n")
            want = [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", text.decode())]
            assert [p.split() for p in pieces] == want


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**18
    df = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long")
    (row,) = df.select(collocations._score(*[df[c] for c in "alr"]).alias("s")).collect()
    assert row.s == 2_000_000 * big // (2 * big + 1)
