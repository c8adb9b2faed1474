"""Runs driven by a stream of landed payloads, and triage states kept from a stream of changes and resets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import SourceSpec
from ..operators.triage import latest_triage_state, reset_triage
from ..plans.nightly import run_once
from ..schema import LANDING_SCHEMA
from ..session import cut_lineage
from ..sources.partners import keep, with_partners


def read_landing(spark: SparkSession, path: str, files_per_run: int | None = None) -> DataFrame:
    """Landed payload files as a stream."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if files_per_run is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_run)
    return reader.parquet(path)


def collect_increment(
    landing: DataFrame,
    snapshot_path: str,
    checkpoint_path: str,
    as_of: Callable[[int], datetime],
    sources: Sequence[SourceSpec] | None = None,
    parity: bool = True,
    landed_path: str | None = None,
) -> StreamingQuery:
    """Every batch of landed payloads is one run, merged into the snapshot.

    Payloads that may have partners are kept under `landed_path` (beside the
    snapshot by default), in a folder that driver and executors share, so that
    they meet whichever batch they come in. Only items with a payload of the batch
    are fresh, so an item never comes back over one that replaced it.

    All past keys live in the snapshot and not in stream state, which would
    grow without end. The batch number is the run number, and `as_of` gives the
    same moment for the same batch, so a batch that is repeated after a failure
    writes the same run again.
    """

    kept = landed_path or f"{snapshot_path.rstrip('/')}-landed"

    def one_run(batch: DataFrame, batch_id: int) -> None:
        new = cut_lineage(batch)
        keep(new, kept, batch_id)
        # every chain reads it
        landed = cut_lineage(with_partners(new, kept, batch_id))
        run_once(landed, snapshot_path, batch_id, as_of(batch_id), sources, parity)

    return (
        landing.writeStream.foreachBatch(one_run)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def triage_state_stream(changes: DataFrame, key: str = "tool_url") -> DataFrame:
    """T1 as a stream: the last state per item, for output mode update or complete."""
    last = F.max_by(F.struct("state", "ts"), F.struct("ts", "seq")).alias("last")
    return changes.groupBy(key).agg(last).select(key, "last.state", "last.ts")


#: A change of an item's state, or a reset of all states (reset is true, the url null).
TRIAGE_EVENT_SCHEMA = "tool_url string, state string, ts bigint, seq bigint, reset boolean"


def _last_events(events: DataFrame) -> DataFrame:
    """The last change of each item and the last reset: all that later reading needs. Combined before the shuffle."""
    events = events.withColumn("reset", F.coalesce("reset", F.lit(False)))
    last = F.max_by(F.struct("state", "ts", "seq"), F.struct("ts", "seq")).alias("last")
    return events.groupBy("reset", "tool_url").agg(last).select("tool_url", "last.state", "last.ts", "last.seq", "reset")


def keep_triage(events: DataFrame, path: str, checkpoint_path: str) -> StreamingQuery:
    """T1 with T2 as a stream of changes and resets, in any order.

    Each batch keeps its last events in a folder of its own, so a batch that is
    repeated writes the same again, and no state in memory grows with the items.
    `path` and `checkpoint_path` belong together: once batches are folded, their
    numbers must not come again for other events.
    `read_triage` tells the states, `fold_triage` makes one folder of many.
    """

    def one_run(batch: DataFrame, batch_id: int) -> None:
        _last_events(batch).write.mode("overwrite").parquet(f"{path}/parts/batch={batch_id}")

    return events.writeStream.foreachBatch(one_run).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _last_fold(spark: SparkSession, path: str) -> int | None:
    return _stored(spark, f"{path}/folds", "through bigint").agg(F.max("through")).first()[0]


def _kept_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of the last finished fold and of the batches after it."""
    folded = _last_fold(spark, path)
    parts = _stored(spark, f"{path}/parts", f"{TRIAGE_EVENT_SCHEMA}, batch bigint")
    if folded is None:
        return parts
    base = spark.read.schema(TRIAGE_EVENT_SCHEMA).parquet(f"{path}/base/through={folded}")
    return base.withColumn("batch", F.lit(folded)).unionByName(parts.where(F.col("batch") > folded))


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    """The states after the last reset, as T1 over T2 gives them for all events kept so far."""
    events = _kept_events(spark, path)
    return latest_triage_state(reset_triage(events.where("not reset"), events.where("reset").select("ts")))


def fold_triage(spark: SparkSession, path: str) -> int | None:
    """Make one folder of all batches kept so far; changes before the last reset go. Returns the last batch folded.

    Rows first, then the record that makes them count. A change that comes late, from before
    the reset, is still left out, since the reset itself is kept.
    """
    events = _kept_events(spark, path)
    through = events.agg(F.max("batch")).first()[0]
    if through is not None and through != _last_fold(spark, path):
        resets = events.where("reset")
        standing = reset_triage(events.where("not reset"), resets.select("ts"))
        _last_events(standing.unionByName(resets)).write.mode("overwrite").parquet(f"{path}/base/through={through}")
        spark.range(1).select(F.lit(through).cast("bigint").alias("last")).coalesce(1).write.mode("overwrite").parquet(f"{path}/folds/through={through}")
    return through
