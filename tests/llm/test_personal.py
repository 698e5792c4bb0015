import re
import time

from pyspark.sql import functions as F

from studiolens.llm import catalog, personal

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def base(row):
    return [(s.kind, s.at, s.end) for s in row.spans]


TEXTS = [
    "a@b.c a@b.c_d@e.f @x.y q@ q@r q@r. é\U0001f600x@y.zz, x@y..z a.b+c%d@e-f.g-h.",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.02.0003.255 999999999999.1.1.1 1.2.3.4a",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1 12 4111111111111111111",
    "+1 (415) 555-2671 +1 +12345678 +1.2.3.4.5.6.7.8 ++49 30 1234567) +1234567890123456",
    "+4111 1111 1111 1111@1.2.3.4.com",
    "",
    None,
    "a" * 30_000 + "@b." + "c." * 20_000 + "d",
    "1" * 60_000,
    "9 " * 40_000,
    "+1" + "(" * 50_000,
    "x@y.z " * 800,
]


def test_base_spans(documents):
    docs = documents(*TEXTS, TEXTS[0]).withColumn("spans", F.lit("old"))
    rows = personal.with_spans(docs).orderBy("doc_id").collect()
    assert [base(r) for r in rows] == [plain(t) for t in [*TEXTS, TEXTS[0]]]
    assert all(r.term_spans == [] for r in rows)


def test_whole_table(spark, sf_documents):
    got = {r.doc_id: r for r in catalog.op3_personal_data(spark, "/root/testdata/sf0.001").collect()}
    for row in sf_documents.collect():
        spans = plain(row.text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        own = got[row.doc_id]
        assert own.spans == listed or own.spans.startswith(listed + ("," if listed else "") + "term:")
        for kind in PLAIN:
            assert own[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)


def test_terms_that_disclose(documents):
    texts = [f"number {i}: Zebrafan writes from jane@site.org on day {i}" for i in range(6)]
    texts += ["only zebrafan, no address", "zebrafans and prezebrafan"]
    texts += [f"number {i}: on day {i} a person writes from afar" for i in range(40)]
    texts += [texts[0], None]  # copies count once
    rows = personal.with_spans(documents(*texts), share=0.9).orderBy("doc_id").collect()
    found = {r.doc_id: [texts[r.doc_id][s.at : s.end] for s in r.term_spans] for r in rows}
    assert found[0] == found[48] == ["Zebrafan"]
    assert found[6] == ["zebrafan"]
    assert found[7] == found[8] == found[49] == []
    out = {r.doc_id: r.text for r in personal.sanitised(documents(*texts), share=0.9).collect()}
    assert out[0] == "number 0: [term] writes from [email] on day 0"
    assert out[7] == texts[7]
    assert out[49] is None
    gone = {r.doc_id: r.text for r in personal.sanitised(documents(*texts), remove_terms=True, share=0.9).collect()}
    assert gone[6] == "only , no address"
    few = personal.with_spans(documents(*texts[:2], *texts[6:]), share=0.9).collect()
    assert all(r.term_spans == [] for r in few)


def test_rare_entities_with_production_parameters(documents):
    """An entity of one text, one written in two ways, and the planted name of the test above."""
    texts = ["then Quillfeather, at quill@site.org, wrote a note", "then call Ombrelwitz: +1 (415) 555-2671 on a day", "then ombrelwitz has +1-415-555-2671 on a day"]
    texts += [f"number {i}: Zebrafan writes from jane@site.org on day {i}" for i in range(6)] + ["only zebrafan, no address"]
    texts += [f"number {i}: then on day {i} a person who wrote a note has to call and writes from afar" for i in range(60)]
    texts += [texts[0]] * 5  # copies count once
    rows = personal.with_spans(documents(*texts)).orderBy("doc_id").collect()
    found = [[texts[r.doc_id][s.at : s.end] for s in r.term_spans] for r in rows]
    want = [["Quillfeather"], ["Ombrelwitz"], ["ombrelwitz"], *[["Zebrafan"]] * 6, ["zebrafan"], *[[]] * 60, *[["Quillfeather"]] * 5]
    assert found == want


def near(text, kind, at, end):
    """Five words on either side of a value, up to other matches of its pattern."""
    matches = [(m.start(), m.end()) for m in re.finditer(PLAIN[kind], text)]
    i = matches.index((at, end))
    low = matches[i - 1][1] if i else 0
    high = matches[i + 1][0] if i + 1 < len(matches) else len(text)
    words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", text)]
    before = [w for a, b, w in words if low <= a and b < at][-5:]
    after = [w for a, b, w in words if end < a and b <= high][:5]
    return {*before, *after}


def test_words_near_values(spark):
    gap = " far " * 100
    texts = [
        "one two three four five six seven a@b.c, eight nine ten eleven twelve thirteen xa@b.cy zwölf",
        f"Quill {gap[:4]}{' ' * 500}a@b.c{' ' * 900}Ombre {'1' * 300} after",
        "abc@b.c.日本語 is 日本語 here", "a@b.c", "wordé@x.y é",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", personal.base_spans(F.col("text")).alias("spans")).collect():
        assert [(s.kind, s.at, s.end) for s in row.spans] == plain(row.text)
        for s in row.spans:
            assert set(s.near) == near(row.text, s.kind, s.at, s.end), (row.text, s)


def test_many_matches_in_one_text(spark):
    """Time grows with the matches, not with their square; blocks are put together rightly."""
    texts = ["person%d@site.org, " * n % tuple(range(n)) for n in (0, 1, 255, 256, 257, 1000, 60_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1)
    begin = time.monotonic()
    rows = df.select("text", F.transform(personal.base_spans(F.col("text")), lambda s: F.struct(s["at"], s["end"])).alias("spans")).collect()
    assert time.monotonic() - begin < 60
    for row in rows:
        assert [(a, b) for a, b in row.spans] == [(a, b) for _, a, b in plain(row.text)]


def test_empty_table(documents):
    none = documents("x").limit(0)
    assert personal.with_spans(none).count() == 0
    assert personal.sanitised(none).count() == 0
