"""Putting sources together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.skew import HOT_ROWS, balanced_join
from .payloads import BATCH, latest_batch


def source_fallback(primary: DataFrame, secondary: DataFrame, failed: DataFrame,
                    keys: Sequence[str] = ("source", "seq"), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The primary rows, and the secondary rows of sources whose primary failed.

    `failed` holds the keys of failed fetches. A primary that answered with no
    rows is not failed, so it has no fallback.
    """
    if BATCH not in failed.columns:
        wanted = failed.select(*keys).distinct()
        return primary.unionByName(balanced_join(secondary, wanted, keys, "left_semi", hot_rows).select(*primary.columns))
    # a feed is wanted from the first failure on
    wanted = failed.groupBy(*keys).agg(F.min(BATCH).alias("failed_batch"))
    found = latest_batch(balanced_join(secondary, wanted, keys, "inner", hot_rows), "failed_batch")
    return primary.unionByName(found.select(*primary.columns))


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources as one DataFrame; a source that landed nothing adds nothing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
