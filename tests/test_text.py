from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gleanspark import config
from gleanspark.functions import text as X

S = F.col("s")


def test_pricing_is_a_substring_test_and_freemium_wins(values):
    texts = ["Freemium free", "freelance", "paid", "Always FREE", "has a free tier", "", None]
    assert values(X.guess_pricing(S), texts) == ["freemium", "free", "unknown", "free", "freemium", "unknown", "unknown"]
    assert values(X.guess_pricing(S, whole_word=True), ["freelance", "it is free."]) == ["unknown", "free"]


def test_listicle_titles(values):
    titles = {
        "Top 10 AI Tools": True, "50 AI Prompts for Marketers": True, "20 ChatGPT Prompts You Need": True, "Notion AI 2.0": False,
        None: False, "→ 7 tools": True, "top 5. tools": False, "10x tools": False, "12 " + "a" * 41 + " tools": False, "3 outils": False,
        "9 toolset": False,
    }
    assert values(X.is_listicle(S), list(titles)) == list(titles.values())


def test_categories_need_whole_words(values):
    texts = ["history profile shortage", "usage illimité", "ILLIMITÉ", "fine-tuning", "images", "a story", "données data", None]
    assert values(X.guess_categories(S), texts) == [
        [], ["usage illimité"], ["usage illimité"], [], [], ["histoires enfants"], ["données"], []]


def test_categories_keep_declaration_order_and_three_at_most(values):
    assert values(X.guess_categories(S), ["quiz csv image video news"]) == [["images", "vidéo", "éducation"]]


def test_term_inside_a_longer_term_counts_for_both_categories(values):
    got = values(X.guess_categories(S), ["video summary", "no-code site", "qr code", "text-to-speech"])
    assert got == [["vidéo", "youtube"], ["automatisation", "site web"], ["qr code"], ["voix", "texte"]]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(
    sorted({t for ts in config.CATEGORY_TERMS.values() for t in ts} | {"-", "é", "_", "x", ".", "ai", "İ", "2"})), max_size=9), min_size=1, max_size=20),
    st.sampled_from([" ", "-", "", "_", ", "]))
def test_one_pass_finds_what_one_pattern_per_category_finds(values, words, glue):
    texts = [glue.join(w) for w in words]
    expected = [
        [c for c, ts in config.CATEGORY_TERMS.items()
         if re.search(r"\b(?:" + "|".join(map(re.escape, ts)) + r")\b", t, re.IGNORECASE)][:3]
        for t in texts]
    assert values(X.guess_categories(S), texts) == expected


def test_terms_must_start_and_end_with_a_letter():
    with pytest.raises(ValueError):
        X._term_pattern(["free +"])


def test_urls(values):
    assert values(X.norm_url(S), [" x.io ", "ftp://x", "httpbin.org", "http://a"]) == ["https://x.io", "https://ftp://x", "httpbin.org", "http://a"]
    assert values(X.url_key(S), ["http://x/A//", "http://x/a", "https://x/a"]) == ["http://x/a", "http://x/a", "https://x/a"]
    assert values(X.name_key(S), [" - ", "__", "My-Tool 2", "a b"]) == ["", "", "mytool2", "ab"]


def test_external(values):
    urls = ["https://www.wikiaitools.com", "https://dev.tools", "https://example.org/github.com", "ftp://x.org", None, "", "httpbin.org"]
    assert values(X.is_external(S), urls) == [False, False, True, False, False, False, True]
    assert values(X.is_external(S, parity=True), urls)[0] is True
    assert values(X.is_external(S, match="suffix"), ["https://dev.tools", "https://x.dev.to/a", "https://dev.to:80"]) == [True, False, False]


def test_show_filter(spark):
    rows = [("Show HN: my AI app", "https://a.io"), ("Show HN: my AI app", "https://a.io/Blog/x"), ("A deep dive into AI", "https://a.io"),
            ("Top 5 AI tools", "https://a.io"), ("Show HN: a game", "https://a.io"), ("my ai", "https://news.ycombinator.com/x"), ("ai", "https://a.io/x.md")]
    df = spark.createDataFrame(rows, "t string, u string")
    assert [r[0] for r in df.select(X.show_filter(F.col("t"), F.col("u"))).collect()] == [True] + [False] * 6


def test_cleaners(values):
    assert values(X.clean_show_prefix(S), ["Show HN: X", "show hn – Y", "SHOW HN-Z", "No Show HN: W"]) == ["X", "Y", "Z", "No Show HN: W"]
    assert values(X.clean_leading_label(S), ["👀 What's happening: it is", "No label here", "Label:x"]) == ["it is", "No label here", "x"]
    assert values(X.clean_discussion_tail(S), ["Good tool Discussion | Link", "Discussion|Link"]) == ["Good tool", ""]
    assert values(X.collapse_whitespace(S), [" a\n\tb   c ", "　"]) == ["a b c", ""]
    assert values(X.excerpt_fallback(S, F.lit("x" * 400)), ["e", "  "]) == ["e", "x" * 300]
    assert values(X.map_pricing_tier(S), ["free", "paid", "contact", None]) == ["free", "paid", "unknown", "unknown"]
    assert values(X.min_length(S, 3), [" ab ", "abc"]) == [False, True]


def test_launch_and_topic_terms(values):
    assert values(X.launch_filter(S), ["Acme LAUNCHES", "nothing"]) == [True, False]
    assert values(X.launch_filter(S, config.LAUNCH_TITLE_TERMS), ["I built it", "startup"]) == [True, False]
    assert values(X.topic_filter(S), ["he said", "ocean"]) == [True, False]
    assert values(X.topic_filter(S, whole_word=True), ["he said", "an AI"]) == [False, True]
