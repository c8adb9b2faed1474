from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gleanspark.operators import terms as M

TERMS = [("ai", 2, "smart"), ("ai", 1, "tech"), ("ai tool", 3, "tools"), ("tool", 3, "tools"), ("été", 0, "saison"), ("a", 9, "letter"), ("", 0, "none"), (None, 0, "none"), ("x", None, "none"),
         ("c++", 4, "code")]
TEXTS = ["an ai tool", "AI", "fair trade", "ai", "l'été, ai_tool", "étés", "", None, "ai", "a c++ ai", "tool" * 3, "nothing"]

paths = pytest.mark.parametrize("max_bytes", [M.AUTOMATON_BYTES, 0], ids=["automaton", "join"])


def expected(text, whole_word, limit=None):
    hits = set()
    for term, rank, label in TERMS:
        if term and text and rank is not None:
            pattern = re.escape(term)
            if re.search(rf"(?<!\w){pattern}(?!\w)" if whole_word else pattern, text):
                hits.add((rank, label))
    return list(dict.fromkeys(label for _, label in sorted(hits)))[:limit]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)], "i int, text string, term string")


@paths
@pytest.mark.parametrize("whole_word", [True, False])
@pytest.mark.parametrize("limit", [None, 1])
def test_labels_equal_a_search_term_by_term(spark, rows, max_bytes, whole_word, limit):
    table = spark.createDataFrame(TERMS, "term string, rank int, label string")
    found = M.with_labels(rows, F.col("text"), table, "found", limit, whole_word, max_bytes).orderBy("i").collect()
    assert [r["found"] for r in found] == [expected(t, whole_word, limit) for t in TEXTS]
    assert [r["term"] for r in found] == ["own"] * len(TEXTS)


@paths
def test_ten_thousand_terms(spark, max_bytes):
    table = spark.range(10_000).select(F.concat(F.lit("t"), "id").alias("term"), (F.col("id") % 7).alias("rank"), F.concat(F.lit("l"), F.col("id") % 7).alias("label"))
    docs = spark.range(60).select("id", F.concat(F.lit("Go T"), F.col("id") * 200, F.lit(", not t"), F.col("id"), F.lit("y")).alias("text"))
    found = M.guess_categories_table(docs, F.col("text"), table, max_bytes=max_bytes).collect()
    # the last ten name terms that aren't there
    assert {r["id"]: r["categories"] for r in found} == {i: [f"l{i * 200 % 7}"] if i < 50 else [] for i in range(60)}


@paths
def test_blocked_parts_of_urls(spark, max_bytes):
    links = spark.createDataFrame([("http://Spam.example/x", 1), ("http://fine.example/", 2), ("http://fine.example/?u=spam.EXAMPLE", 3), (None, 4), ("", 5)], "href string, hits int")
    blocklist = spark.createDataFrame([("SPAM.example",), (None,), ("",)], "domain string")
    assert sorted(r["hits"] for r in M.blocklist_contains_table(links, blocklist, max_bytes=max_bytes).collect()) == [2, 4, 5]
    assert M.blocklist_contains_table(links, blocklist.limit(0), max_bytes=max_bytes).count() == 5
    assert M.blocklist_contains_table(links.limit(0), blocklist, max_bytes=max_bytes).count() == 0


def test_a_hot_text_and_a_hot_run(spark):
    table = spark.createDataFrame([("ai", 0, "tech")], "term string, rank int, label string")
    docs = spark.range(500).select("id", F.when(F.col("id") < 300, "ai").otherwise(F.concat(F.lit("ai "), "id")).alias("text"))
    assert M.with_labels(docs, F.col("text"), table, max_bytes=0, hot_rows=50).where("labels = array('tech')").count() == 500
