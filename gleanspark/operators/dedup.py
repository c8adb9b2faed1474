"""Deduplication and the cumulative merge.

Rows have an arrival order. `greedy_dedup` keeps a row when neither its url key
nor its name key belongs to a kept row, exactly as if the rows came one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import config
from ..functions.text import min_length, name_key, url_key
from ..schema import ARRIVAL_ORDER
from ..session import cut_lineage
from .order import with_position
from .skew import HOT_ROWS, hot_keys, is_small, salted_join

# rounds before chains are looked at: most data is done by then
PLAIN_ROUNDS = 4


def with_keys(items: DataFrame) -> DataFrame:
    """Both dedup keys added."""
    return items.withColumns({"url_key": url_key(F.col("tool_url")), "name_key": name_key(F.col("name"))})


def _rank(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def greedy_winners(edges: DataFrame, hot_rows: int = HOT_ROWS, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Ranks kept by the greedy rule from edges (rank, u, n), unique in rank.

    Works in rounds: a row that comes first among the rows left both for its
    url and for its name is certain to be kept; all rows that share a key with
    it leave. The smallest ranks per key are combined before their shuffle and
    meet on the rank, which is unique, so only joins of all rows left with
    their keys can see a hot key, and those are salted. What is left after
    `plain_rounds` holds chains, in which each row waits for the one before it;
    from then on a round also decides whole chains.
    """
    edges = cut_lineage(edges)
    left = edges.count()
    edges, unpack = _packed(edges)
    hot_u, hot_n = (hot_keys(edges, [k], hot_rows) if left > hot_rows else [] for k in ("u", "n"))
    kept = []
    while left:
        first_u = edges.groupBy("u").agg(F.min("rank").alias("rank"))
        first_n = edges.groupBy("n").agg(F.min("rank").alias("rank"))
        if len(kept) < plain_rounds:
            wins = cut_lineage(first_u.join(first_n, "rank").select("rank", "u", "n"))
        else:
            wins = _chained(edges, first_u, first_n, hot_u, hot_n)
        kept.append(wins)
        edges = salted_join(edges, wins.select("u"), ["u"], "left_anti", hot_u)
        edges = cut_lineage(salted_join(edges, wins.select("n"), ["n"], "left_anti", hot_n))
        left = edges.count()
    return reduce(DataFrame.unionByName, kept, edges.limit(0)).select(unpack(F.col("rank")).alias("rank"), "u", "n")


def _chained(edges: DataFrame, first_u: DataFrame, first_n: DataFrame, hot_u: list[int], hot_n: list[int]) -> DataFrame:
    """The rows that come first for both keys, and every second row of the chains that start at them.

    A row with just one earlier row among those left, which shares its url or its
    name, is kept exactly if that one isn't. Such rows point at the row they
    wait for; pointers are followed by doubling, so a chain of n rows takes
    log2(n) steps, and what counts at its end is whether the distance is even.
    Pointers that end at a row with several earlier ones stay open this round.
    """
    placed = salted_join(edges, first_u.withColumnRenamed("rank", "first_u"), ["u"], "inner", hot_u)
    placed = cut_lineage(salted_join(placed, first_n.withColumnRenamed("rank", "first_n"), ["n"], "inner", hot_n).select("rank", "u", "n", "first_u", "first_n"))

    def waiting(own: str, other: str, key: str) -> DataFrame:
        """Rows that are first for the other key and second for `key`."""
        second = placed.where(F.col("rank") > F.col(own)).groupBy(key).agg(F.min("rank").alias("rank")).select("rank")
        return placed.where((F.col("rank") == F.col(other)) & (F.col("rank") > F.col(own))).join(second, "rank", "left_semi").select("rank", F.col(own).alias("to"))

    free = placed.where((F.col("rank") == F.col("first_u")) & (F.col("rank") == F.col("first_n")))
    pointers = cut_lineage(waiting("first_u", "first_n", "u").unionByName(waiting("first_n", "first_u", "n")).withColumn("odd", F.lit(True)))
    moved = not pointers.isEmpty()
    while moved:
        step = pointers.select(F.col("rank").alias("to"), F.col("to").alias("on"), F.col("odd").alias("more"))
        joined = pointers.join(step, "to", "left")
        pointers = cut_lineage(joined.select(
            "rank", F.coalesce("on", "to").alias("to"), (F.col("odd") != F.coalesce("more", F.lit(False))).alias("odd"), F.col("on").isNotNull().alias("moved")))
        moved = not pointers.where("moved").isEmpty()
        pointers = pointers.drop("moved")
    even = pointers.where("not odd").join(free.select(F.col("rank").alias("to")), "to", "left_semi").select("rank")
    return cut_lineage(free.select("rank", "u", "n").unionByName(placed.join(even, "rank", "left_semi").select("rank", "u", "n")))


def _packed(edges: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Edges with a rank of several whole numbers packed into one bigint, in the same order, and how to unpack it.

    The smallest bigint per key is found by hash aggregation, the smallest
    struct only by sorting. Ranks that need more than 63 bits stay as they are.
    """
    parts = edges.schema["rank"].dataType
    if not isinstance(parts, T.StructType) or not all(isinstance(f.dataType, T.IntegralType) for f in parts):
        return edges, lambda rank: rank
    names = parts.names
    limits = edges.agg(*[f(f"rank.{c}").alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]).first()
    bits = [(limits[f"max_{c}"] or 0).bit_length() for c in names]
    if sum(bits) > 63 or any((limits[f"min_{c}"] or 0) < 0 for c in names):
        return edges, lambda rank: rank
    shifts = [sum(bits[i + 1:]) for i in range(len(names))]
    packed = F.lit(0).cast("bigint")
    for name, shift in zip(names, shifts):
        packed = packed.bitwiseOR(F.shiftleft(F.col(f"rank.{name}").cast("bigint"), shift))

    def unpack(rank: Column) -> Column:
        return F.struct(*[
            F.shiftright(rank, shift).bitwiseAND(F.lit((1 << width) - 1)).cast(part.dataType).alias(part.name)
            for part, shift, width in zip(parts, shifts, bits)])

    return edges.withColumn("rank", packed), unpack


def greedy_dedup(
    items: DataFrame,
    order: Sequence[str] = ARRIVAL_ORDER,
    url: str = "url_key",
    name: str = "name_key",
    hot_rows: int = HOT_ROWS,
    plain_rounds: int = PLAIN_ROUNDS,
    unique: bool = True,
) -> DataFrame:
    """Rows kept by the greedy rule; `order` is unique per row, but for rows that landed more than once.

    Where rows of several runs share their place in the order, say so with unique=False:
    among them the smaller keys come first.

    Only (rank, url, name) goes through the rounds. A later row with the same
    pair of keys can never be kept, so pairs are combined before the first
    shuffle. The wide rows are read once more at the end, to pick the kept ones.
    A null key counts as the empty one.
    """
    rank = _rank(order)
    u, n = (F.coalesce(F.col(c), F.lit("")) for c in (url, name))
    edges = items.groupBy(u.alias("u"), n.alias("n")).agg(F.min(rank).alias("rank"))
    edges = edges.select("rank", "u", "n")
    if unique:
        winners = greedy_winners(edges, hot_rows, plain_rounds)
    else:
        # a position for each pair of keys stands for its rank
        placed = cut_lineage(with_position(cut_lineage(edges), ["rank", "u", "n"], "place"))
        won = greedy_winners(placed.select(F.col("place").alias("rank"), "u", "n"), hot_rows, plain_rounds)
        winners = placed.join(won.select(F.col("rank").alias("place")), "place", "left_semi").select("rank", "u", "n")
    ranks = [F.col("rank").alias(order[0])] if len(order) == 1 else [F.col(f"rank.{c}").alias(c) for c in order]
    keyed = items.withColumns({"winner_u": u, "winner_n": n})
    by = [*order, "winner_u", "winner_n"]
    kept = keyed.join(winners.select(*ranks, F.col("u").alias("winner_u"), F.col("n").alias("winner_n")), by, "left_semi")
    # a payload that landed twice brings a winner twice: one row of it stays, the same in each run
    row = F.xxhash64(*[F.col(c) for c in items.columns])
    return first_per_key(kept.withColumn("winner_row", row), by, ["winner_row"]).drop("winner_u", "winner_n", "winner_row")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order. Spark keeps one row per key and task before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_in_key", F.row_number().over(first)).where("row_in_key = 1").drop("row_in_key")


def distinct_first(hits: DataFrame, url: str = "tool_url", order: Sequence[str] = ARRIVAL_ORDER, within: Sequence[str] = ()) -> DataFrame:
    """First row per exact url, optionally within a group such as one payload."""
    return first_per_key(hits, [*within, url], order)


def distinct_links_per_article(links: DataFrame, article: Sequence[str], href: str = "href", order: Sequence[str] = ("pos",)) -> DataFrame:
    """D3: first link per article and lower-cased, slash-stripped target."""
    return first_per_key(links.withColumn("link_key", url_key(F.col(href))), [*article, "link_key"], order).drop("link_key")


def cumulative_merge(fresh: DataFrame, previous: DataFrame, assume_clean: bool = True, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """All fresh rows, and the previous ones that share neither url nor name with them.

    With `assume_clean` both sides are results of the greedy rule, so keys are
    unique on each side, no key can be hot, and two anti joins are exact.
    The keys of one run's rows are sent to every executor when they are proven
    small, so that the snapshot is read but not shuffled; larger ones are
    shuffled. Without `assume_clean` the greedy rule runs over both, fresh rows
    first.
    """
    if not assume_clean:
        both = fresh.withColumn("run_age", F.lit(0)).unionByName(previous.withColumn("run_age", F.lit(1)))
        # previous rows may come from several runs that numbered theirs alike
        return greedy_dedup(both, ["run_age", *order], unique=False).drop("run_age")
    old = previous
    for key in ("url_key", "name_key"):
        taken = fresh.select(key)
        old = old.join(F.broadcast(taken) if is_small(taken) else taken, key, "left_anti")
    return fresh.unionByName(old)


def finalize_snapshot(merged: DataFrame, chars: int = config.MIN_NAME_CHARS) -> DataFrame:
    """Names that are too short leave, after the merge, so they may have shadowed other rows."""
    return merged.where(min_length(F.col("name"), chars))
