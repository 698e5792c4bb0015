import hashlib
import random

from pyspark.sql import functions as F

from studiolens.llm import catalog, repeats


def plain(texts, length=200):
    """(bytes, removed, runs, digest of what stays) per text."""
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, texts, **how):
    got = sorted(repeats.without_repeats(docs, **how).collect(), key=lambda r: r.doc_id)
    want = plain([(t or "").encode() for t in texts])
    assert [tuple(r[c] for c in repeats.ADDED) for r in got] == want
    return got


def test_cover_meets_at_every_distance():
    assert {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))


def test_ranges_are_all_distances():
    assert [d for a, b in repeats._RANGES for d in range(a, b + 1)] == list(range(repeats.PERIOD))


def test_passages_at_random_places(documents, monkeypatch):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passages = [word(n) for n in (199, 200, 201, 233, 260, 332, 333, 700, 2000)]
    texts = []
    for _ in range(60):
        parts = [word(draw.randrange(150))]
        for _ in range(draw.randrange(4)):
            p = draw.choice(passages)
            cut = draw.randrange(40)
            parts += [p[cut:] if draw.random() < 0.3 else p, word(draw.randrange(150))]
        texts.append("".join(parts))
    texts += ["x" * 150, "y" * 250, "zq" * 400, texts[0], "é" * 120 + word(50) + "é" * 120, "", None]
    monkeypatch.setattr(repeats, "FILE_ROWS", 7)  # many files
    check(documents(*texts), texts, bucket_names=50)


def test_string_shared_with_a_surer_one(documents):
    """One text agrees with two others that agree in more: it has a partner only among those."""
    draw = random.Random(9)
    word = lambda n: "".join(draw.choice("abcdefgh") for _ in range(n))
    for near in (0, 1, 60, 132):
        core, left, right = word(200), word(150), word(150)
        texts = [left + core + right, word(near) + left + core + right, word(77) + core + word(50)]
        check(documents(*texts), texts)


def test_texts_that_begin_or_end_alike(documents):
    draw = random.Random(2)
    word = lambda n: "".join(draw.choice("abcdefgh") for _ in range(n))
    head, tail = word(210), word(205)
    texts = [head + word(30), head + word(9), word(40) + tail, word(11) + tail, head, word(200)]
    check(documents(*texts), texts)


def test_odd_rows(documents):
    long = "abc " * 30_000
    docs = documents((3, None), (1, "same text " * 30), (2, "same text " * 30), (5, long)).withColumn("n_spans", F.lit("old"))
    got = check(docs, ["same text " * 30, "same text " * 30, None, long], keep_bytes=True)
    assert [bytes(r.kept) for r in got] == [b""] * 4
    assert got[0].source == "a"
    assert repeats.without_repeats(documents("x").limit(0)).count() == 0


def test_whole_table(spark, sf_documents):
    rows = sf_documents.orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r)[1:] for r in catalog.op6_repeated_strings(spark, "/root/testdata/sf0.001").collect()}
    want = plain([(r.text or "").encode() for r in rows])
    assert [got[r.doc_id] for r in rows] == want
