import pytest
from pyspark.sql import functions as F

from studiolens.llm import url_filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def judged(spark, urls, rules=RULES, default="allow"):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.judge(pages.withColumn("rule", F.lit("old")), url_filter.rule_table(spark, rules), default)
    return [tuple(r) for r in rows.select("page_id", "host", "path", "rule", "verdict").orderBy("page_id").collect()]


def test_rules(spark):
    cases = [
        ("https://www.Example.ORG/es/1?x=/de/#y", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://a.b.com/de/", "a.b.com", "/de/", "com/de/", "block"),
        ("http://a.b.com/DE/", "a.b.com", "/DE/", None, "allow"),
        ("http://com/de", "com", "/de", None, "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://example.org?/es/", "example.org", "", None, "allow"),
        ("no scheme.org/es/", "", "", None, "allow"),
        ("http://a.com/x://b.org/es/", "a.com", "/x://b.org/es/", None, "allow"),
        ("://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
        ("x\ny://Ärger.com/de/ü\nz", "Ärger.com", "/de/ü\nz", "com/de/", "block"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://" + "a." * 5000 + "com/de/" + "b" * 50_000, "a." * 5000 + "com", "/de/" + "b" * 50_000, "com/de/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    ]
    assert judged(spark, [c[0] for c in cases]) == [(i, *c[1:]) for i, c in enumerate(cases)]


def test_ties_and_default(spark):
    rules = [("allow", "a.com/"), ("block", "a.com/"), ("allow", "a.com/"), ("allow", "b.com/x"), ("allow", "b.com/x")]
    rows = judged(spark, ["http://a.com/", "http://b.com/xy", "http://c.com/"], rules, "block")
    assert [r[3:] for r in rows] == [("a.com/", "block"), ("b.com/x", "allow"), (None, "block")]


def test_kept_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/", "h"), (2, "http://x.com/", "h")], "page_id long, url string, html string")
    rules = url_filter.rule_table(spark, RULES)
    kept = url_filter.kept(pages, rules)
    assert kept.columns == pages.columns
    assert [r.page_id for r in kept.collect()] == [2]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_rule_without_path_is_refused(spark):
    with pytest.raises(ValueError, match="org"):
        url_filter.rule_table(spark, [("allow", "com/"), ("block", "org")])
