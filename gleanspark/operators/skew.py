"""Joins that stay balanced when one key holds a large share of the rows.

The right side of these joins has one row per key. Keys with more than
`hot_rows` rows on the left are found first by counting, which combines before
the shuffle. Their left rows are spread over `SALTS` parts and the matching
right rows, few by construction, are repeated once per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 200_000
MAX_HOT_KEYS = 256
SALTS = 64
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with more than `hot_rows` rows, largest first, at most MAX_HOT_KEYS.

    The list is short by its limit, so it may come to the driver. A key that
    is not on it only costs balance, never rows.
    """
    counts = df.groupBy(_key_hash(keys).alias("key")).count().where(F.col("count") > hot_rows)
    return [row["key"] for row in counts.orderBy(F.desc("count"), "key").limit(MAX_HOT_KEYS).collect()]


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: list[int]) -> DataFrame:
    """Equi join with the hot left keys spread; `right` is unique on `keys`."""
    keys = list(keys)
    if not hot:
        return left.join(right, keys, how)
    is_hot = _key_hash(keys).isin(hot)
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    every_part = F.sequence(F.lit(0), F.lit(SALTS - 1))
    left = left.withColumn("salt", F.when(is_hot, spread).otherwise(0))
    right = right.withColumn("salt", F.explode(F.when(is_hot, every_part).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*keys, "salt"], how).drop("salt")


def balanced_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`salted_join` with the hot keys counted on the left first.

    Counting reads the left keys once more. Give None where the caller knows
    that no key can be hot, such as keys inside one payload.
    """
    return salted_join(left, right, keys, how, [] if hot_rows is None else hot_keys(left, keys, hot_rows))


def is_small(keys: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a one-column DataFrame of strings is proven small enough to send to every executor."""
    size = F.sum(F.coalesce(F.octet_length(keys.columns[0]), F.lit(0)) + F.lit(ROW_OVERHEAD))
    return (keys.agg(size).first()[0] or 0) <= max_bytes
