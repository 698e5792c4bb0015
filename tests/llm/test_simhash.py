import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from studiolens.llm import catalog, simhash
from studiolens.llm.components import connected_components


def plain_print(text, k):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    """Smallest index reachable for each fingerprint."""
    table = np.array(prints, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(table ^ p) <= bits) for p in table]
    labels = np.arange(len(prints))
    while True:
        lower = np.array([labels[n].min() for n in near])
        if (lower == labels).all():
            return labels.tolist()
        labels = lower


def test_whole_table(spark, sf_documents):
    rows = sf_documents.orderBy("doc_id").collect()
    prints = [plain_print(r.text, 4) for r in rows]
    first = plain_components(prints, 4)
    want = {r.doc_id: (format(p, "016x"), rows[f].doc_id) for r, p, f in zip(rows, prints, first, strict=True)}
    got = catalog.op10_simhash_near_copies(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_links_of_clustered_prints(spark):
    """Dense groups, chains and strangers, with buckets cut into parts of three."""
    draw = np.random.default_rng(3)
    prints = set()
    for centre in draw.integers(0, 2**63, 12).tolist():
        for _ in range(15):
            flips = draw.choice(64, draw.integers(0, 8), replace=False).tolist()
            prints.add(centre ^ sum(1 << b for b in flips))
    prints = sorted(prints)
    first = plain_components(prints, 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for part in (3, 2048):
        links = simhash.close_links(spark.createDataFrame([(p,) for p in signed], "fp long"), part=part)
        found = {r.node: r.component for r in connected_components(links).collect()}
        groups = {}
        for i, p in enumerate(signed):
            groups.setdefault(found.get(p, p), set()).add(i)
        want = {}
        for i, f in enumerate(first):
            want.setdefault(f, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_chain_star_and_loop(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r.node: r.component for r in rows}
    assert len(rows) == len(found)
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert found == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_texts(documents):
    text = "one two three four five six seven eight nine ten"
    docs = documents(
        (1, None), (2, ""), (3, " \t\n"), (4, text), (4, text), (5, text.upper()), (6, "one"), (None, text), (7, "word " * 60_000)
    ).withColumn("component_id", F.lit("old"))
    rows = simhash.with_components(docs).collect()
    assert len(rows) == 9
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert found[1] == found[2] == found[3] == ("0" * 16, 1)
    assert found[4] == found[5] == found[None]
    assert found[4][1] == 4
    assert found[6] == (format(plain_print("one", 5), "016x"), 6)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.component_id) for r in kept.collect()) == [(i, "old") for i in (1, 4, 6, 7)]


def test_empty_table(documents):
    none = documents("x").limit(0)
    assert simhash.with_components(none).count() == 0
    assert simhash.deduplicated(none).count() == 0


def test_one_stays_without_ids(documents):
    docs = documents((None, "a b c d e f"), (None, "A b c d e f"), (None, "something else altogether, really"))
    assert simhash.deduplicated(docs).count() == 2


def test_long_text_in_little_memory():
    """A text of 8 MB: words are places in it, not objects."""
    import tracemalloc

    text = " ".join(f"w{i % 9973} \t\n" for i in range(1_000_000)).encode()
    tracemalloc.start()
    own = simhash.fingerprint(text, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words = text.split()[:50_000]
    short = b"\n".join(words) + b" "
    assert own != bytes(8)
    assert peak < 12 * len(text)
    assert int.from_bytes(simhash.fingerprint(short, 4)) == plain_print(short.decode(), 4)
    for text in ("", " \n", "a", " A b\x0bC ", "\x1c\x1d x", "é \x85 É"):
        assert int.from_bytes(simhash.fingerprint(text.encode(), 4)) == plain_print(text, 4)
