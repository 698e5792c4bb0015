import zlib

import numpy as np
from pyspark.sql import functions as F

from studiolens.llm import catalog, language

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = catalog.op1_language(spark, SF_DIR).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    own = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in own)
    assert right / len(own) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_vector_is_the_sum_of_bound_letters():
    profiler = language.Profiler(64)
    letters = {c: profiler._letter(ord(c)).astype(int) for c in " ab"}
    bound = lambda a, b, c: np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    want = bound(" ", "a", "b") + bound("a", "b", " ")
    assert (profiler.vector("AB") == want).all()
    assert (profiler.vector("--ab!!") == want).all()


def test_large_vocabulary_does_not_change_vectors(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog"
    want = language.Profiler(64).vector(text)
    monkeypatch.setattr(language, "_CACHED", 3)
    profiler = language.Profiler(64)
    profiler.vector("something else entirely")
    assert (profiler.vector(text) == want).all()


def test_odd_texts(documents):
    docs = documents(
        (1, "the cat and the dog", "en"),
        (2, "le chat et le chien", "fr"),
        (3, None, "en"),
        (4, "", "fr"),
        (5, "123 -- !!", None),
        (None, "the dog and the cat", None),
        (1, "the cat and the dog", "en"),
        (6, "the dog " * 50_000, None),
    ).withColumn("lang_pred", F.lit("old"))
    rows = language.with_language(docs, docs).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == 8
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == ("fr" if r.doc_id == 2 else "en")
    kept = language.spoken(docs, docs)
    assert kept.columns == docs.columns
    assert kept.count() == 5


def test_empty_tables(documents):
    none = documents("x").limit(0)
    assert language.with_language(none, none).count() == 0
    rows = language.with_language(documents("a text"), none).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


def test_letters_beyond_the_basic_plane(documents):
    """Emoji and symbols are no letters; Deseret capitals are lower-cased, rare ideographs are letters."""
    taught = documents((0, "le chat est sur la table", "fr"), (4, "the cat sat on the mat", "en"), (5, "𐐨𐐩𐐪 𐐨𐐩", "de"))
    docs = documents((1, "😀😀 🎉"), (2, "😀 chat 😀"), (3, "𝟘𝟙 12"), (6, "𐐀𐐁𐐂 𐐀𐐁"), (7, "𠀀"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.with_language(docs, taught).collect()}
    assert got[1] == got[3] == ("und", 0.0)
    assert got[2][0] == "fr"
    assert got[6][0] == "de" and abs(got[6][1] - 1) < 1e-6
    assert got[7][0] != "und"


def test_many_trigrams_in_little_memory():
    import tracemalloc

    draw = np.random.default_rng(1)
    text = "".join(map(chr, draw.integers(0x4E00, 0x9FA5, 200_000).tolist()))
    profiler = language.Profiler(256)
    tracemalloc.start()
    vector = profiler.vector(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert vector is not None
    # All trigrams at once would take 200,000 x 256 floats twice.
    assert peak < 200e6


def test_predictions_against_brute_force(documents):
    """Every score is the cosine with the sum of the language's vectors, letter by letter."""
    texts = [("fr", "le chat"), ("fr", "la table"), ("en", "the cat"), ("en", "a mat"), (None, "chat la")]
    docs = documents(*[(i, text, lang) for i, (lang, text) in enumerate(texts)])
    profiler = language.Profiler()

    def slow(text):
        letters = [" ", *text.lower(), " "]
        own = [profiler._letter(ord(c)).astype(float) for c in letters]
        return sum(np.roll(a, 2) * np.roll(b, 1) * c for a, b, c in zip(own, own[1:], own[2:], strict=False))

    sums = {lang: sum(slow(t) for own, t in texts if own == lang) for lang in ("fr", "en")}
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    for row in language.with_language(docs, docs).collect():
        scores = {lang: cosine(slow(texts[row.doc_id][1]), s) for lang, s in sums.items()}
        best = max(scores, key=scores.get)
        assert row.lang_pred == best
        assert abs(row.score - scores[best]) < 1e-5
