"""One run: collect, deduplicate, merge into the snapshot, write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..config import SourceSpec
from ..operators.dedup import cumulative_merge, finalize_snapshot, greedy_dedup, with_keys
from ..operators.items import new_count, run_stats
from ..session import cut_lineage
from ..sources.payloads import BATCH
from ..sources.snapshot import snapshot_scan, write_files, write_run_stats, write_snapshot
from .collect import collect


@dataclass(frozen=True)
class RunResult:
    """What a run gives: the new snapshot, the rows of this run, and the one-row record."""

    snapshot: DataFrame
    fresh: DataFrame
    stats: DataFrame


def merge_run(collected: DataFrame, previous: DataFrame, as_of: datetime) -> RunResult:
    """Items of a run merged into the previous snapshot (an earlier result, with keys)."""
    fresh = cut_lineage(greedy_dedup(with_keys(collected)))
    snapshot = finalize_snapshot(cumulative_merge(fresh, previous))
    return RunResult(snapshot, fresh, run_stats(snapshot, fresh, previous, as_of.isoformat()))


def run_once(landing: DataFrame, path: str, run_id: int, as_of: datetime,
             sources: Sequence[SourceSpec] | None = None, parity: bool = True) -> None:
    """Collect what landed and write run `run_id`.

    The previous snapshot is the last one below `run_id`, so a repeated run
    reads and writes the same data. Collected items are written to the
    checkpoint folder first: payloads are parsed once, not once per job.

    Where payloads tell the run they landed in (`batch`), only items with a payload
    of this run are fresh; the others were merged when their last payload landed.
    """
    previous = snapshot_scan(landing.sparkSession, path, before=run_id)
    collected = collect(landing, as_of, sources, parity)
    if BATCH in collected.columns:
        collected = collected.where(F.col(BATCH) == run_id).drop(BATCH)
    collected = cut_lineage(collected)
    result = merge_run(collected, previous, as_of)
    write_snapshot(result.snapshot, path, run_id)
    # the list of files has the counts already
    files = write_files(landing.sparkSession, path, run_id)
    stats = files.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("count")).crossJoin(new_count(result.fresh, previous))
    write_run_stats(stats.select(F.lit(as_of.isoformat()).alias("generated_at"), "count", "new_today"), path, run_id)
