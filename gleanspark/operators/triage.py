"""People's decisions on items: state, views, order, selection, export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import config
from ..schema import ARRIVAL_ORDER
from .skew import HOT_ROWS, balanced_join

PENDING = config.TRIAGE_STATES[0]
FREE_OF_CHARGE = ["free", "freemium"]
#: Newest first by the date string, then as the rows came. " desc" after a name turns its order; nulls then come last.
SNAPSHOT_ORDER = ("date_iso desc", *ARRIVAL_ORDER)
ITEM_SEPARATOR = f"\n\n{config.EXPORT_RULE}\n\n"


def _names(order: Sequence[str]) -> list[str]:
    return [c.removesuffix(" desc") for c in order]


def _sorting(order: Sequence[str]) -> list[Column]:
    return [F.col(n).asc() if n == c else F.col(n).desc() for n, c in zip(_names(order), order, strict=True)]


def latest_triage_state(changes: DataFrame, key: str = "tool_url", order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """The last state per item, from changes (key, state, ts, seq). Combined before the shuffle."""
    last = F.max_by(F.struct("state", "ts"), F.struct(*order)).alias("last")
    return changes.groupBy(key).agg(last).select(key, "last.state", "last.ts")


def reset_triage(changes: DataFrame, resets: DataFrame) -> DataFrame:
    """Only changes after the last reset; `resets` is (ts)."""
    last = resets.agg(F.max("ts")).scalar()
    return changes.where(F.coalesce(F.col("ts") > last, F.lit(True)))


def with_triage_state(items: DataFrame, triage: DataFrame, key: str = "tool_url", hot_rows: int | None = None) -> DataFrame:
    """Items with their state, pending when there is none.

    A snapshot has each url once, so a plain join is balanced. For other
    inputs give `hot_rows`, and keys above it are spread.
    """
    states = triage.select(key, "state")
    joined = items.join(states, key, "left") if hot_rows is None else balanced_join(items, states, [key], "left", hot_rows)
    return joined.withColumn("state", F.coalesce("state", F.lit(PENDING)))


def prune_triage(triage: DataFrame, items: DataFrame, key: str = "tool_url") -> DataFrame:
    """States of items that are still in the snapshot."""
    return triage.join(items.select(key), key, "left_semi")


def triage_counts(triaged: DataFrame, new_today: int | Column = 0) -> DataFrame:
    """A3: one row of counts. Ignored items count only in the total."""
    new = new_today if isinstance(new_today, Column) else F.lit(new_today)
    return triaged.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("state") == "pub").alias("pub"),
        F.count_if(F.col("state") == "done").alias("done"),
        F.count_if(F.col("state") == PENDING).alias("pending"),
        F.count_if(F.col("pricing").isin(FREE_OF_CHARGE)).alias("free"),
    ).withColumn("new_today", new.cast("bigint"))


def triage_view(triaged: DataFrame, view: str = "all") -> DataFrame:
    """V1: all, pending, pub, done, or free (free or freemium in any state)."""
    if view == "all":
        return triaged
    if view == "free":
        return triaged.where(F.col("pricing").isin(FREE_OF_CHARGE))
    if view in (PENDING, "pub", "done"):
        return triaged.where(F.col("state") == view)
    raise ValueError(f"unknown view {view!r}")


def pricing_rank(pricing: Column, parity: bool = False) -> Column:
    """Rank of a pricing among pending items. With `parity` free ranks like unknown, after freemium."""
    ranks = {"freemium": 1, "free": 2 if parity else 0, "paid": 3}
    known = F.coalesce(*[F.when(pricing == p, F.lit(r)) for p, r in ranks.items()])
    return F.coalesce(known, F.lit(2))


def triage_order(triaged: DataFrame, order: Sequence[str] = SNAPSHOT_ORDER, parity: bool = False) -> DataFrame:
    """L3, for the view of all items: pending ones first by pricing, the others after them.

    Ties keep snapshot order. When there are only pending items, or none, it stays as it is.
    """
    pending = F.col("state") == PENDING
    mixed = triaged.agg(F.bool_or(pending) & F.bool_or(~pending)).scalar()
    rank = F.when(mixed & pending, pricing_rank(F.col("pricing"), parity)).otherwise(0)
    part = F.when(mixed & ~pending, 1).otherwise(0)
    return triaged.withColumns({"part": part, "pricing_rank": rank}).orderBy("part", "pricing_rank", *_sorting(order))


def selection_list(triaged: DataFrame) -> DataFrame:
    """V2: items to publish, with their categories in one line."""
    line = F.array_join(F.coalesce("categories", F.array().cast("array<string>")), config.CATEGORY_SEPARATOR)
    return triaged.where(F.col("state") == "pub").select("name", "tool_url", line.alias("categories"))


def _or_default(value: Column, default: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def export_block(triaged: DataFrame, order: Sequence[str] = SNAPSHOT_ORDER) -> DataFrame:
    """K3: one text block per item to publish, as (order columns, block) in snapshot order.

    Every block but the first starts with the separating rule, so the blocks
    read one after the other are the whole export, however many there are.
    """
    picked = triaged.where(F.col("state") == "pub")
    place = F.struct(*_names(order))
    first = picked.orderBy(*_sorting(order)).limit(1).select(place).scalar()
    labels = config.EXPORT_LABELS
    none = config.EXPORT_NO_VALUE
    block = F.concat(
        F.col("name"), F.lit("\n"), F.col("tool_url"), F.lit("\n\n"),
        _or_default(F.col("description"), config.EXPORT_NO_DESCRIPTION), F.lit("\n\n"),
        F.lit(labels["categories"]), _or_default(F.array_join("categories", ", "), none), F.lit("\n"),
        F.lit(labels["source"]), _or_default(F.col("source"), none), F.lit("\n"),
        F.lit(labels["pricing"]), _or_default(F.col("pricing"), none),
    )
    rule = F.when(place.eqNullSafe(first), "").otherwise(ITEM_SEPARATOR)
    return picked.select(*_names(order), F.concat(rule, block).alias("block")).orderBy(*_sorting(order))


def write_export(triaged: DataFrame, path: str, order: Sequence[str] = SNAPSHOT_ORDER) -> None:
    """Export as text files whose names sort in snapshot order.

    The line break that ends each row stands for the first one of the next
    separator, so the files read in name order give the export.
    """
    blocks = export_block(triaged, order)
    blocks.select(F.regexp_replace("block", r"^\n", "").alias("value")).write.mode("errorifexists").text(path)
