"""Dirty input that once failed a job or kept duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanspark.functions.dates import epoch_to_iso, iso_timestamp, parse_date
from gleanspark.operators import dedup as D
from gleanspark.operators import joins as J
from gleanspark.operators.skew import is_small


def test_offsets_beyond_eighteen_hours(values):
    dates = ["2026-04-22T10:00:00+19:00", "2026-04-22T10:00:00+99:00", "Wed, 22 Apr 2026 10:00:00 +1900", "2026-04-22T10:00:00-02:30"]
    assert values(parse_date(F.col("s")), dates) == ["2026-04-22T10:00:00+19:00", None, "2026-04-22T10:00:00+19:00", "2026-04-22T10:00:00-02:30"]
    assert values(F.unix_seconds(iso_timestamp(F.col("s"))), dates[:2] + dates[3:]) == [1776783600, None, 1776861000]


def test_epoch_out_of_range(values):
    assert values(epoch_to_iso(F.col("s").cast("bigint")), ["99999999999999999", "1776765600000", "0", "-62135596801"]) == [
        None, None, "1970-01-01T00:00:00+00:00", None]


def test_rows_landed_twice_stay_once(spark):
    rows = spark.createDataFrame([(0, "u1", "n1"), (1, "u2", "n1"), (2, "u2", "n3")], "rank int, url_key string, name_key string")
    got = D.greedy_dedup(rows.unionAll(rows), order=["rank"])
    assert sorted(map(tuple, got.collect())) == [(0, "u1", "n1"), (2, "u2", "n3")]


def test_first_reply_of_a_story_fetched_twice(spark):
    items = spark.createDataFrame([(1, "a", "")], "story_id int, author string, description string")
    replies = [(1, 1, 0, "a", "B"), (1, 0, 0, "a", "A")]
    for some in (replies, replies[::-1]):
        df = spark.createDataFrame(some, "story_id int, seq int, pos int, author string, text string")
        assert J.first_author_reply(items, df).first()["description"] == "A"


def test_nulls_count_towards_a_broadcast(spark):
    assert not is_small(spark.range(100).select(F.lit(None).cast("string").alias("k")), max_bytes=1_000)
