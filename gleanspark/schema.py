"""Declared schemas of records, payloads and triage data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

ITEM_FIELDS = ["name", "tool_url", "description", "source", "date_iso", "categories", "pricing"]
ARRIVAL_ORDER = ["source_rank", "seq", "pos"]

ITEM_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("tool_url", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("date_iso", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("pricing", T.StringType()),
])

# One landed payload. `seq` orders the payloads of a source, `status` is "ok" or "failed".
LANDING_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("payload", T.StringType()),
])

RUN_STATS_SCHEMA = "run_id bigint, generated_at string, count bigint, new_today bigint"
TRIAGE_SCHEMA = "tool_url string, state string, ts bigint"

# entries of RSS and RDF feeds, and of Atom feeds
FEED_ITEM = """title: string, link: string, guid: struct<_VALUE: string, _isPermaLink: string>, description: string, `content:encoded`: string,
    pubDate: string, `dc:date`: string, updated: string"""
FEED_ENTRY = "title: string, link: array<struct<_href: string, _rel: string>>, summary: string, content: string, published: string, updated: string"
FEED_SCHEMA = f"channel struct<item: array<struct<{FEED_ITEM}>>>, item array<struct<{FEED_ITEM}>>, entry array<struct<{FEED_ENTRY}>>"
HITS_SCHEMA = """
    hits array<struct<title: string, url: string, created_at_i: bigint, story_text: string,
                      objectID: string, author: string>>
"""
REPLIES_SCHEMA = "children array<struct<author: string, text: string>>"
POSTS_SCHEMA = """
    array<struct<title: struct<rendered: string>, link: string, content: struct<rendered: string>,
                 excerpt: struct<rendered: string>, date: string>>
"""
SITEMAP_ENTRY = "loc: string, lastmod: string"
SITEMAP_SCHEMA = f"url array<struct<{SITEMAP_ENTRY}>>"


def as_items(df: DataFrame) -> DataFrame:
    """Rows of an older snapshot brought to the item schema; fields they lack get their defaults."""
    empty = df.sparkSession.createDataFrame([], ITEM_SCHEMA)
    full = empty.unionByName(df, allowMissingColumns=True)
    return full.withColumns({
        "date_iso": F.coalesce("date_iso", F.lit("")),
        "categories": F.coalesce("categories", F.array().cast("array<string>")),
        "pricing": F.coalesce("pricing", F.lit("unknown")),
    })
