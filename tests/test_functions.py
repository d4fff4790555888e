import hashlib

import pytest
from pyspark.sql import functions as F

from actionwatch.functions import dates, lists, text


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast("array<string>").alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "want"), [("on 2024-03-05.", "2024-03-05"), ("March 5, 2024", "2024-03-05"), ("03.05.2024", "2024-03-05"), ("3/5/24", "2024-03-05"), ("2024-13-01", None), ("", None), ("Smarch 5, 2024", None), ("2026-13-01 8/1/2026", None), ("Sept 31, 2026 1/2/2026", None), ("May 5, 1998 or 1/2/1998", "1998-01-02"), ("Room 12, 2024 08.12.2026", "2026-08-12"), (None, None)])
def test_parse_date(spark, given, want):
    got = one(spark, dates.parse_date(F.col("t")), t=given)
    assert (str(got) if got else None) == want


def test_title_splits_at_last_dash(spark):
    both = text.split_title_outlet(F.col("t"), F.lit("fallback"))
    assert tuple(one(spark, both, t="A - B - Out")) == ("A - B", "Out")
    assert tuple(one(spark, both, t="plain")) == ("plain", "fallback")


@pytest.mark.parametrize(("given", "want"), [("2", 2), (" 2 ", 2), ("2.7", None), (2.7, 2), (3, 3), (4.0, None), ("x", None), ("4", None)])
def test_relevance(spark, given, want):
    assert one(spark, lists.clamp_relevance(F.col("r"), F.col("c")), r=given, c=["digital"]) == want
    assert one(spark, lists.clamp_relevance(F.col("r"), F.col("c")), r=given, c=[]) is None


def test_valid_list_keeps_order_and_repeats(spark):
    assert one(spark, lists.valid_list(F.col("v"), ["a", "b"]), v=["b", "x", "a", "b"]) == ["b", "a", "b"]
    assert one(spark, lists.primary(F.col("v"), ["a", "b"]), v=["x", "b", "a"]) == "b"


def test_event_id_is_order_free(spark):
    want = hashlib.sha1(b"https://a\nhttps://\xc3\xa9").hexdigest()[:16]
    for urls in (["https://a", "https://é"], ["https://é", "", "https://a"]):
        assert one(spark, text.event_id(F.col("u")), u=urls) == want


def test_gov_rules_differ(spark):
    url = "https://x.gov.example/a"
    assert one(spark, text.source_kind(F.col("u")), u=url) == "press"
    assert one(spark, text.source_kind(F.col("u"), strict=False), u=url) == "primary"
    assert one(spark, text.host(F.col("u")), u="no url") == "link"


def test_primary_and_press(spark):
    assert one(spark, text.primary_and_press(F.col("u")), u=["https://p1.example/", "https://a.gov/", "https://p2.example/"]) == ["https://a.gov/", "https://p1.example/"]
    assert one(spark, text.primary_and_press(F.col("u")), u=["https://p1.example/", "https://p2.example/", "https://p3.example/"]) == ["https://p1.example/", "https://p2.example/"]
    assert one(spark, text.primary_and_press(F.col("u")), u=[]) == []


def test_verdict_json(spark):
    v = text.verdict_json(F.col("t"), "pass boolean, why string")
    assert tuple(one(spark, v, t='```json\n{"pass": true, "why": "a"}\n```')) == (True, "a")
    assert tuple(one(spark, v, t='Sure: {"pass": false, "why": "b"} {"pass": true}')) == (False, "b")
    assert one(spark, v, t="none") is None


def test_blurb(spark):
    problem = text.blurb_problem(F.col("t"), F.lit("Ohio"))
    assert one(spark, problem, t="Gov. Lee of Ohio signed. It starts now.") is None
    assert one(spark, problem, t="Ohio acts.") == "sentences"
    assert one(spark, problem, t="Ohio acts; more. Then rest.") == "punctuation"
    assert one(spark, problem, t="They act. Then rest.") == "state"
    assert one(spark, problem, t="H.R. 1 passed in Ohio. It starts now.") is None
    assert one(spark, text.sentences(F.col("t")), t="J. D. Vance spoke. He left.  Why?") == ["J. D. Vance spoke.", "He left.", "Why?"]


def test_issue_links_and_feeds(spark):
    html = '<a href="/issues/tax">Tax</a><a href="https://other.example/issues">x</a><a class="k" href="plans#top"><b>Our</b> issues</a><a href="//h.example/issues/tax">again</a><a href="/about">About</a><a href="?issues=1">q</a>'
    got = one(spark, text.issue_links(F.col("h"), F.lit("https://h.example/a/b?x"), "(?i)issue"), h=html)
    assert got == ["https://h.example/issues/tax", "https://h.example/a/plans"]
    assert one(spark, text.issue_links(F.col("h"), F.lit("https://h.example/"), "(?i)issue", cap=1), h=html) == got[:1]
    head = '<link rel="alternate" type="application/rss+xml" href="/rss"><LINK REL="stylesheet" type="text/css" href="/c"><link type="application/atom+xml" href="https://f.example/a" rel="alternate home">'
    assert one(spark, text.advertised_feeds(F.col("h"), F.lit("https://h.example/x/y")), h=head) == ["https://h.example/rss", "https://f.example/a"]


def test_article_body(spark):
    html = "<p>out</p><script><p>x</p></script><article><p>" + "a" * 300 + "</p><p>" + "b" * 300 + "</p></article>"
    assert one(spark, text.article_body(F.col("h")), h=html) == "a" * 300 + " " + "b" * 300
    assert one(spark, text.article_body(F.col("h")), h="<p>short</p>") is None


def test_outlets_and_names(spark):
    assert one(spark, text.outlet_summary(F.col("o"), 2), o=["a", "b", "c"]) == "a, b +1 more"
    assert one(spark, text.name_variants(F.col("n")), n="Ann B. Mae Lee") == ["Ann B. Mae Lee", "Ann Mae Lee", "Ann Lee"]
    assert one(spark, text.slug_title(F.col("t"), F.lit("https://x/big-news_today/")), t="Big...") == "Big news today"


def test_white_space_is_stripped(spark):
    assert one(spark, text.word_count(F.col("t")), t="\n two\twords \n") == 2
    assert one(spark, text.split_list(F.col("t")), t=" a \n\t\nb\t") == ["a", "b"]
    assert one(spark, text.first_sentences(F.col("t"), 1), t="\n One. Two.") == "One."
