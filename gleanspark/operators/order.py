"""Positions in one order over all rows, without a window over all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.session import cut_lineage


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position", first: int = 0) -> DataFrame:
    """`df` with a column `name` that counts its rows from `first` in `order`.

    Rows are sorted in ranges, one task each, and numbered there; the sizes of
    the ranges, one row per task, are summed and sent to the tasks. Rows that are
    equal in `order` get positions next to each other, and so many of them that
    they fill a range are dealt over several. The sorted rows are written to the
    checkpoint folder, so that positions don't change when a task is repeated.
    """
    at, part = (_free(df, n) for n in ("at", "part"))
    # a row number splits equal rows between ranges
    ranged = df.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    numbered = cut_lineage(ranged.withColumn(at, F.monotonically_increasing_id()))
    # the upper bits of that number are the task's, the lower 33 the row's in it
    numbered = numbered.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = numbered.groupBy(part).agg(F.count("*").alias(name))
    before = sizes.select(part, (F.sum(name).over(Window.orderBy(part)) - F.col(name) + first).alias(name))
    return numbered.join(F.broadcast(before), part).withColumn(name, F.col(name) + F.col(at)).drop(at, part)


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
