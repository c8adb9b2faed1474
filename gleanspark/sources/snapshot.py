"""Snapshot store: one folder per run, a list of its files, and a one-row record that makes the run visible.

    <path>/items/run_id=<n>/     the snapshot after run n
    <path>/files/run_id=<n>/     its files: bytes, rows, and a checksum of the rows
    <path>/runs/run_id=<n>/      generated_at, count, new_today

A run is written items first, record last, each to a folder of its own, so
nothing is overwritten while it is read and a repeated run gives the same files.
The record is one file, which the commit moves into place at once. A reader goes
back to the last run whose files are those on the list, so a run that is
damaged, cut off or half deleted is passed over.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedup import with_keys
from ..operators.items import newest_first
from ..schema import ARRIVAL_ORDER, ITEM_FIELDS, ITEM_SCHEMA, RUN_STATS_SCHEMA, as_items

FILES_SCHEMA = "run_id bigint, file string, bytes bigint, rows bigint, checksum bigint"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small tables of the store; none when nothing has been written yet. A file that can't be read holds no rows."""
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Records of all finished runs."""
    return _read(spark, f"{path}/runs", RUN_STATS_SCHEMA)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of all runs."""
    return _read(spark, f"{path}/files", FILES_SCHEMA)


def _present(spark: SparkSession, path: str, run_id: int) -> DataFrame:
    """(file, bytes) in a run's folder, by its listing alone."""
    found = spark.read.format("binaryFile").load(f"{path}/items/run_id={run_id}")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def _contents(spark: SparkSession, path: str, run_id: int) -> DataFrame:
    """(file, bytes, rows, checksum) as read from a run's files. The checksum doesn't depend on the order of rows."""
    rows = spark.read.parquet(f"{path}/items/run_id={run_id}")
    about = rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.xxhash64(*rows.columns).alias("hash"))
    return about.groupBy("file", "bytes").agg(F.count("*").alias("rows"), F.bit_xor("hash").alias("checksum"))


def is_whole(spark: SparkSession, path: str, run_id: int, contents: bool = False) -> bool:
    """Whether a run's files are those on its list, by name and size; with `contents` by their rows too.

    Runs before the first one with a list are of an older store, and taken as they are.
    """
    lists = read_files(spark, path).where(F.col("run_id") <= run_id)
    listed = lists.where(F.col("run_id") == run_id).drop("run_id")
    if listed.isEmpty():
        return lists.isEmpty()
    fields = ["file", "bytes", "rows", "checksum"] if contents else ["file", "bytes"]
    try:
        found = (_contents if contents else _present)(spark, path, run_id).select(fields)
        # files without rows aren't on the list
        return listed.where("rows > 0").select(fields).exceptAll(found).isEmpty() and (contents or found.join(listed, "file", "left_anti").isEmpty())
    except (PySparkException, Py4JJavaError):
        return False


def latest_run(spark: SparkSession, path: str, before: int | None = None, contents: bool = False) -> int | None:
    """Id of the last finished run whose files are whole, or of the last such one before `before`."""
    runs = read_runs(spark, path)
    if before is not None:
        runs = runs.where(F.col("run_id") < before)
    while (run_id := runs.agg(F.max("run_id")).first()[0]) is not None:
        if is_whole(spark, path, run_id, contents):
            return run_id
        runs = runs.where(F.col("run_id") < run_id)
    return None


def snapshot_scan(spark: SparkSession, path: str, before: int | None = None, contents: bool = False) -> DataFrame:
    """The latest whole snapshot with its dedup keys; empty when there is none.

    `source_rank`, `seq` and `pos` are the arrival order the rows were stored with.
    Damage that changes a file's size or name is always noticed, any other with `contents`,
    which reads the snapshot once more.
    """
    run_id = latest_run(spark, path, before, contents)
    order_fields = "source_rank int, seq bigint, pos bigint"
    if run_id is None:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ITEM_SCHEMA)
        return with_keys(spark.createDataFrame([], f"{fields}, {order_fields}"))
    return with_keys(as_items(spark.read.parquet(f"{path}/items/run_id={run_id}")))


def write_snapshot(snapshot: DataFrame, path: str, run_id: int, order: list[str] = ARRIVAL_ORDER) -> DataFrame:
    """K1: the whole snapshot. Returns it as written.

    Rows are newest first within each file and keep their order columns. The
    order over all files is made by `newest_first` where it is asked for, so
    that a run does not shuffle the whole snapshot.
    """
    rows = snapshot.select(*ITEM_FIELDS, *order).sortWithinPartitions(F.desc("date_iso"), *order)
    rows.write.mode("overwrite").parquet(f"{path}/items/run_id={run_id}")
    return snapshot.sparkSession.read.parquet(f"{path}/items/run_id={run_id}")


def write_files(spark: SparkSession, path: str, run_id: int) -> DataFrame:
    """The list of a run's files, read back from what was written. Returns (file, bytes, rows, checksum)."""
    there = _present(spark, path, run_id).withColumnRenamed("bytes", "size")
    found = there.join(_contents(spark, path, run_id), "file", "left")
    files = found.select("file", F.col("size").alias("bytes"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("rows", "checksum")])
    files.coalesce(1).write.mode("overwrite").parquet(f"{path}/files/run_id={run_id}")
    return spark.read.parquet(f"{path}/files/run_id={run_id}")


def write_run_stats(stats: DataFrame, path: str, run_id: int) -> None:
    """K2: the run's record; from here on the run can be read."""
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run_id={run_id}")


def expire_runs(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the last `keep` whole runs, record first, so that a run half deleted is no run. Returns the deleted runs.

    Damaged runs older than the last whole one kept go too; newer ones stay, for whoever looks into them.
    """
    runs = [r["run_id"] for r in read_runs(spark, path).select("run_id").orderBy(F.desc("run_id")).collect()]
    whole = [r for r in runs if is_whole(spark, path, r)][:keep]
    old = [r for r in runs if len(whole) == keep and r < whole[-1]]
    for run_id in old:
        for part in ("runs", "files", "items"):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/run_id={run_id}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return old


def export_json(snapshot: DataFrame, path: str, order: list[str] = ARRIVAL_ORDER) -> None:
    """K1 as JSON lines in UTF-8, newest first over the files in name order."""
    newest_first(snapshot, order).select(*ITEM_FIELDS).write.mode("errorifexists").json(path)
