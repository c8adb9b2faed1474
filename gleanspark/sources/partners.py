"""Landed payloads kept for partners that land in later batches.

A newsletter issue and its article, a sitemap and its pages, failed posts and
the feed of the same site, a story and its replies may land in any order. The
store keeps those kinds of payload, and one row per story that a search answer
holds, in folders by kind, bucket of the key and batch:

    <path>/kind=<kind>/bucket=<b>/batch=<n>/

A batch reads only the buckets of keys that it touches, and of these the row
groups whose keys lie between the smallest and the largest one touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..schema import LANDING_SCHEMA
from .payloads import BATCH, PAYLOAD_KEY, not_fetched, search_hits_scan

BUCKETS = 64
LISTS = ["feed", "sitemap"]
STORY = "story"
STORE_SCHEMA = "source string, seq bigint, url string, status string, payload string, kind string, bucket int, batch bigint"
FIELDS = [*LANDING_SCHEMA.names, BATCH]


def _bucket(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def _completing() -> Column:
    """Payloads that complete a list: pages, and posts that could not be fetched or read."""
    return (F.col("kind") == "page") | (F.col("kind") == "posts") & not_fetched("posts")


def stories(hits: DataFrame) -> DataFrame:
    """One row per story and search answer, kind `story`, the story as url."""
    found = search_hits_scan(hits.where("kind = 'hits' and status = 'ok'"))
    told = found.where(F.col("story_id").isNotNull()).select(*PAYLOAD_KEY, F.col("story_id").alias("url")).distinct()
    blank = F.lit(None).cast("string")
    return told.select("source", F.lit(STORY).alias("kind"), "seq", "url", F.lit("ok").alias("status"), blank.alias("payload"))


def keep(payloads: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> None:
    """Add a batch to the store. A batch that is repeated writes its own folders again."""
    partnered = payloads.where(F.col("kind").isin(*LISTS, "hits", "replies") | _completing()).select(*LANDING_SCHEMA.names)
    # replies and stories are looked up by story, all others by payload
    bucket = F.when(F.col("kind").isin("replies", STORY), _bucket(["url"], buckets)).otherwise(_bucket(PAYLOAD_KEY, buckets))
    rows = partnered.unionByName(stories(payloads)).withColumn("bucket", bucket).withColumn(BATCH, F.lit(batch))
    ordered = rows.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", *PAYLOAD_KEY, "url")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "bucket", BATCH).parquet(path)


def kept(df: DataFrame, path: str, before: int) -> DataFrame:
    """What batches before `before` kept; nothing if there is no store yet."""
    try:
        return df.sparkSession.read.schema(STORE_SCHEMA).parquet(path).where(F.col(BATCH) < before)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return df.sparkSession.createDataFrame([], STORE_SCHEMA)


def _touched(store: DataFrame, kinds: Sequence[str], keys: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    """Rows of `kinds` in the store whose `by` is among `keys`. The driver learns buckets and bounds, never keys."""
    keys = keys.select(*by).where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])).distinct()
    about = keys.agg(F.collect_set(_bucket(by, buckets)).alias("buckets"), *[f(c).alias(f"{f.__name__}_{c}") for c in by for f in (F.min, F.max)]).first()
    near = F.col("kind").isin(*kinds) & F.col("bucket").isin(about["buckets"])
    for c in by:
        near &= F.col(c).between(about[f"min_{c}"], about[f"max_{c}"])
    return store.where(near).join(keys, list(by), "left_semi").select(*FIELDS)


def with_partners(payloads: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """The payloads of a batch and those kept that make items with them; `batch` tells when each landed.

    Kept lists meet new pages and failures, kept pages and failures new lists; a
    kept search answer comes back for new replies to one of its stories, and
    kept replies for new answers and new replies to the same story.
    """
    store = kept(payloads, path, batch)
    new_replies = payloads.where("kind = 'replies'").select("url")
    late = _touched(store, ["page", "posts"], payloads.where(F.col("kind").isin(*LISTS)), PAYLOAD_KEY, buckets)
    lists = _touched(store, LISTS, payloads.where(_completing()), PAYLOAD_KEY, buckets)
    answers = _touched(store, ["hits"], _touched(store, [STORY], new_replies, ["url"], buckets), PAYLOAD_KEY, buckets)
    replies = _touched(store, ["replies"], new_replies.unionByName(stories(payloads).select("url")), ["url"], buckets)
    new = payloads.select(*LANDING_SCHEMA.names, F.lit(batch).cast("bigint").alias(BATCH))
    return reduce(DataFrame.unionByName, [late, lists, answers, replies], new)
