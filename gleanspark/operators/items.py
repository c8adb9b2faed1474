"""Item records: building, ordering, capping, counting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config
from ..functions import text as X
from ..functions.dates import iso_timestamp
from ..schema import ARRIVAL_ORDER
from .skew import is_small


def item_columns(
    name: Column,
    url: Column,
    description: Column,
    source: Column,
    date_iso: Column,
    default_date: str | Column,
    pricing: Column | None = None,
    category_terms: Mapping[str, Sequence[str]] = config.CATEGORY_TERMS,
) -> list[Column]:
    """The seven fields of a record. Categories and pricing see the whole name and description."""
    described = F.coalesce(description, F.lit(""))
    combined = F.concat(name, F.lit(" "), described)
    guessed = X.guess_pricing(combined)
    default_date = default_date if isinstance(default_date, Column) else F.lit(default_date)
    return [
        X.strip_space(X.truncate_text(name, config.NAME_CHARS)).alias("name"),
        X.norm_url(url).alias("tool_url"),
        X.collapse_whitespace(X.truncate_text(described, config.DESCRIPTION_CHARS)).alias("description"),
        source.alias("source"),
        F.coalesce(F.nullif(date_iso, F.lit("")), default_date).alias("date_iso"),
        X.guess_categories(combined, category_terms).alias("categories"),
        (guessed if pricing is None else F.coalesce(F.nullif(pricing, F.lit("")), guessed)).alias("pricing"),
    ]


def cap_per_source(
    rows: DataFrame, cap: int, keys: Sequence[str] = ("source", "seq"), order: Sequence[str] = ("pos",), own_cap: Column | None = None,
) -> DataFrame:
    """L2: the first `cap` rows per source by position; `own_cap` may be lower for some sources.

    The number lets Spark cut each task's rows before the shuffle, so a source
    with a third of all rows sends no more than `cap` rows per task.
    """
    numbered = rows.withColumn("row_in_source", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    capped = numbered.where(F.col("row_in_source") <= cap)
    if own_cap is not None:
        capped = capped.where(F.col("row_in_source") <= own_cap)
    return capped.drop("row_in_source")


def newest_first(items: DataFrame, order: Sequence[str] = ARRIVAL_ORDER, chronological: bool = False) -> DataFrame:
    """L1: newest first, by the date string or (chronological) by its instant; arrival order breaks ties."""
    by = iso_timestamp(F.col("date_iso")) if chronological else F.col("date_iso")
    return items.orderBy(by.desc(), *order)


def count_by_source(items: DataFrame) -> DataFrame:
    """A1: items per source, most first."""
    return items.groupBy("source").agg(F.count("*").alias("items")).orderBy(F.desc("items"), "source")


def count_by_pricing(items: DataFrame) -> DataFrame:
    """A2: items per pricing; a missing one counts as unknown."""
    pricing = F.coalesce("pricing", F.lit(config.UNKNOWN_PRICING)).alias("pricing")
    return items.groupBy(pricing).agg(F.count("*").alias("items"))


def never_seen(fresh: DataFrame, previous: DataFrame) -> DataFrame:
    """Fresh rows whose url key (the name does not matter) is not in the previous snapshot.

    When the fresh keys are proven small, the snapshot's keys are matched where
    they lie and only the known ones move; otherwise both sides are shuffled.
    """
    known = previous.select("url_key")
    keys = fresh.select("url_key").distinct()
    if is_small(keys):
        known = known.join(F.broadcast(keys), "url_key", "left_semi")
    return fresh.join(known, "url_key", "left_anti")


def new_count(fresh: DataFrame, previous: DataFrame) -> DataFrame:
    """J2 as a count, one row. Fresh rows are counted per url key before the join, so no key is hot."""
    unseen = never_seen(fresh.groupBy("url_key").agg(F.count("*").alias("rows")), previous)
    return unseen.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("new_today"))


def run_stats(snapshot: DataFrame, fresh: DataFrame, previous: DataFrame, generated_at: str) -> DataFrame:
    """K2: one row: when, how many items, how many never seen before."""
    return snapshot.agg(F.count("*").alias("count")).select(
        F.lit(generated_at).alias("generated_at"), "count", new_count(fresh, previous).scalar().alias("new_today"))
