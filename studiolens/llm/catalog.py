"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.llm import (
    collocations,
    decontaminate,
    language,
    mixing,
    near_vectors,
    personal,
    repair,
    repeats,
    secret_scan,
    simhash,
    token_counts,
    token_store,
    url_filter,
)
from studiolens.llm.shared import read, staged

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    return language.with_language(docs, docs.where(~F.col("held_out"))).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_documents(token_store.write_tokens(read(spark, sf_dir, "documents")))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.with_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in personal.KINDS
    ]
    base = F.transform("spans", lambda s: personal.listed(s["kind"], s["at"], s["end"]))
    terms = F.transform("term_spans", lambda s: personal.listed(F.lit(personal.TERM), s["at"], s["end"]))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.with_hits(docs, benchmark).select("doc_id", *decontaminate.ADDED)


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.with_links(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept"
    )


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs).select("doc_id", *repeats.ADDED)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.with_copies(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", taken
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(read(spark, sf_dir, "pages"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_token_counts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit"
    )


def op10_simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.with_components(docs, words=4).select("doc_id", "fingerprint", "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    own = [rule.kind for rule in secret_scan.BASE]
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in own]
    base = F.filter("spans", lambda s: s["kind"].isin(own))

    def listed(spans: Column | str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["end"])), ",")

    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    rows = repair.damaged(conversations)
    report = staged(repair.report(rows), "report")
    shas = repair.digests(repair.repaired(rows, report)).select(F.col("conv_id").alias("s"), "sha256")
    found = report.withColumnRenamed("conv_id", "r")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        conversations.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("r")), "left")
        .join(shas, F.col("conv_id").eqNullSafe(F.col("s")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


QUERIES: tuple[Query, ...] = (
    op1_language,
    op2_token_store,
    op3_personal_data,
    op4_decontaminate,
    op5_near_vectors,
    op6_repeated_strings,
    op7_mix_sources,
    op8_url_filter,
    op9_token_counts,
    op10_simhash_near_copies,
    op11_collocations,
    op12_secret_scan,
    op13_conversation_repair,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


_OP4 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM starts),
places AS (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n),
occ AS (
  SELECT p.rid, p.i, p.n, g.item_id
  FROM (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM places) p JOIN grams g ON p.n = g.n AND p.gram = g.gram
),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS k FROM occ) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM occ) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN names USING (rid)
"""

_OP7 = """
WITH sized AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM per
),
-- A level is right if the sources below their caps at it, and the caps of the others, add up to everything.
levels AS (
  SELECT (SELECT sum(source_size) FROM per) AS total, c.source_size * 3 / c.w AS edge,
         sum(CASE WHEN s.source_size * 3 / s.w < c.source_size * 3 / c.w THEN s.source_size * 3 ELSE 0 END) AS capped,
         sum(CASE WHEN s.source_size * 3 / s.w < c.source_size * 3 / c.w THEN 0 ELSE s.w END) AS open_w
  FROM weighed c, weighed s GROUP BY ALL
),
level AS (
  SELECT arg_min((total - capped) / open_w, edge) AS v FROM levels WHERE (total - capped) / open_w <= edge
),
goal AS (
  SELECT source, source_size, least((source_size * 3)::DOUBLE, w * v) AS target FROM weighed, level
),
rated AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('7|' || coalesce(d.doc_id::VARCHAR, '') || '|' || coalesce(md5(d.text), '')), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS coin
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""

_OP8 = """
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
cut AS (
  SELECT page_id, url, regexp_extract(rest, '^[^?#]*') AS plain FROM parts
),
named AS (
  SELECT page_id, url,
         translate(split_part(plain, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(plain, length(split_part(plain, '/', 1)) + 1) AS path
  FROM cut
),
rules(rule, rhost, rpath, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
),
judged AS (
  SELECT n.url, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT url, host, path FROM named) n
  JOIN rules r ON (n.host = r.rhost OR suffix(n.host, '.' || r.rhost)) AND starts_with(n.path, r.rpath)
  GROUP BY n.url
)
SELECT n.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, j.rule, coalesce(j.verdict, 'allow') AS verdict
FROM named n LEFT JOIN judged j ON n.url = j.url
"""

_OP11 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30
),
candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
),
lowest AS (
  SELECT lang, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), score * 10 + j) AS cut FROM cuts GROUP BY lang, phrase, a
),
inner_phrases AS (
  SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM candidates WHERE k > 2))
),
covered AS (SELECT lang, phrase, max(f) AS over FROM inner_phrases GROUP BY lang, phrase),
ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY cut.score DESC, a DESC, encode(l.phrase)) AS rank
  FROM lowest l LEFT JOIN covered c ON c.lang = l.lang AND c.phrase = l.phrase
  WHERE NOT coalesce(100::HUGEINT * over >= 80::HUGEINT * a, false)
)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontaminate": _OP4,
        "op7_mix_sources": _OP7,
        "op8_url_filter": _OP8,
        "op11_collocations": _OP11,
    }
