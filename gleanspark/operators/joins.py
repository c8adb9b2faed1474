"""Lookups by author, slug and domain."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import config
from ..functions.text import contains_any, host_matches, url_host
from .skew import HOT_ROWS, balanced_join


def first_author_reply(
    items: DataFrame, replies: DataFrame, as_text: Callable[[Column], Column] = lambda reply: reply,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Items (story_id, author, description) without a description get their author's first reply.

    Replies are (story_id, pos, author, text), with seq if a story may have been
    fetched more than once; first is the smallest (seq, pos, text). And `as_text` makes the picked
    one a description. The first reply per story and
    author is combined before the shuffle, so a story with very many replies
    sends one row per task.
    """
    said = replies.where(F.coalesce(F.col("text"), F.lit("")) != "")
    by = F.struct(*[c for c in ("seq", "pos", "text") if c in said.columns])
    # with `batch` on both sides, an item that a reply describes carries the later one
    batch = [F.min_by("batch", by).alias("reply_batch")] if "batch" in said.columns and "batch" in items.columns else []
    first = said.groupBy("story_id", "author").agg(F.min_by("text", by).alias("reply"), *batch)
    joined = balanced_join(items, first, ["story_id", "author"], "left", hot_rows)
    blank = F.coalesce("description", F.lit("")) == ""
    if batch:
        joined = joined.withColumn("batch", F.when(blank, F.greatest("batch", "reply_batch")).otherwise(F.col("batch"))).drop("reply_batch")
    filled = F.when(blank, F.coalesce(as_text(F.col("reply")), F.lit(""))).otherwise(F.col("description"))
    return joined.withColumn("description", filled).drop("reply")


def last_by_slug(pairs: DataFrame, values: Sequence[str], slug: Sequence[str] = ("slug",), order: Sequence[str] = ("pos",)) -> DataFrame:
    """The last value per slug that is not null, for each of `values`; combined before the shuffle."""
    by = F.struct(*order)
    return pairs.groupBy(*slug).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), by)).alias(v) for v in values])


def lookup_by_slug(
    tools: DataFrame, lookup: DataFrame, defaults: dict[str, object], slug: Sequence[str] = ("slug",),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Values of a lookup that is unique on `slug`, with a default where it has none."""
    joined = balanced_join(tools, lookup, slug, "left", hot_rows)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})


def blocklist_anti(
    links: DataFrame,
    href: str = "href",
    url_domains: Sequence[str] = config.SOCIAL_DOMAINS,
    host_domains: Sequence[str] = config.PRESS_DOMAINS,
    match: str = "suffix",
) -> DataFrame:
    """J6 with fixed lists: links to none of the domains.

    match="contains" is the original test: a social domain anywhere in the
    url, a press domain anywhere in the host. The default compares whole host
    suffixes, so ft.com does not drop microsoft.com.
    """
    host = url_host(F.col(href))
    if match == "contains":
        return links.where(~contains_any(F.lower(F.col(href)), url_domains) & ~host_matches(host, host_domains))
    return links.where(~host_matches(host, [*url_domains, *host_domains], "suffix"))


def blocklist_anti_table(links: DataFrame, blocklist: DataFrame, href: str = "href", hot_rows: int = HOT_ROWS) -> DataFrame:
    """J6 with a blocklist table (domain) of any size: links whose host is not on or under a listed domain.

    Distinct hosts are matched by their suffixes first; the result has one row
    per blocked host, and the links meet it in a balanced join.
    """
    located = links.withColumn("host", F.regexp_replace(url_host(F.col(href)), r":\d+$", ""))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_suffix = located.select("host").distinct().select("host", F.explode(suffixes).alias("domain"))
    listed = blocklist.select(F.lower("domain").alias("domain")).distinct()
    # a top level such as "com" is a suffix of very many hosts
    blocked = balanced_join(by_suffix, listed, ["domain"], "left_semi", hot_rows).select("host").distinct()
    return balanced_join(located, blocked, ["host"], "left_anti", hot_rows).drop("host")
