"""Snapshot store in hash buckets: a run writes the buckets that it touches and no others.

    <path>/items/run_id=<n>/bucket=<b>/    rows of the snapshot, by a hash of the url key
    <path>/names/run_id=<n>/bucket=<b>/    (name_key, url_key) of each row, by a hash of the name key
    <path>/index/run_id=<n>/               which run's folder holds each bucket as of run n, and its rows

A fresh row replaces rows with its url key, which lie in its own bucket, and rows
with its name key, which the names tell the buckets of. Those buckets are read,
merged and written anew; of all others the index goes on naming the folder they
are in. The index is one file and written last, so a run is there or it isn't; it
also carries the number of rows, so that no run counts the whole snapshot.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.dedup import finalize_snapshot
from ..operators.skew import is_small
from ..session import cut_lineage

BUCKETS = 64
INDEX_SCHEMA = "run_id bigint, part string, bucket int, holder bigint, rows bigint, generated_at string, new_today bigint"
ITEMS, NAMES = "items", "names"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All runs' indexes; one row per bucket with rows, and one of part `run` per run."""
    try:
        return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INDEX_SCHEMA)


def _held(spark: SparkSession, path: str, before: int | None) -> dict[tuple[str, int], tuple[int, int]]:
    """(part, bucket) -> (holder, rows) as of the last run (before `before`): at most two entries per bucket."""
    index = read_index(spark, path)
    if before is not None:
        index = index.where(F.col("run_id") < before)
    last = index.agg(F.max("run_id")).first()[0]
    rows = [] if last is None else index.where((F.col("run_id") == last) & (F.col("part") != "run")).collect()
    return {(r["part"], r["bucket"]): (r["holder"], r["rows"]) for r in rows}


def _read(like: DataFrame, path: str, part: str, held: dict, wanted: Iterable[int] | None = None) -> DataFrame:
    """The rows of some buckets, or of all, from the folders that hold them."""
    folders = [f"{path}/{part}/run_id={holder}/bucket={b}" for (p, b), (holder, _) in sorted(held.items()) if p == part and (wanted is None or b in wanted)]
    spark = like.sparkSession
    return spark.read.schema(like.schema).parquet(*folders) if folders else spark.createDataFrame([], like.schema)


def _write(rows: DataFrame, key: str, path: str, part: str, run_id: int, buckets: int) -> dict[int, int]:
    """Write rows by bucket, one file each; the rows of each bucket written."""
    folder = f"{path}/{part}/run_id={run_id}"
    rows.withColumn("bucket", _bucket(F.col(key), buckets)).repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    try:
        back = rows.sparkSession.read.parquet(folder)
    except AnalysisException as e:
        # no row, no file to tell the schema from
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return {}
    return {r["bucket"]: r["count"] for r in back.groupBy("bucket").count().collect()}


def _sent(keys: DataFrame) -> DataFrame:
    """Keys for a join, sent to every task if they are proven small."""
    return F.broadcast(keys) if is_small(keys) else keys


def _buckets(keys: DataFrame, key: str, buckets: int) -> set[int]:
    return set(keys.agg(F.collect_set(_bucket(F.col(key), buckets))).first()[0])


def merge_into_buckets(fresh: DataFrame, path: str, run_id: int, generated_at: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Merge a run's rows (results of the greedy rule, with url_key and name_key) into the store.

    Gives the snapshot that cumulative_merge and finalize_snapshot give, and the
    record of the run: count and new_today. The number of buckets is the store's
    for good. A run that is repeated writes its own folders again.
    """
    spark = fresh.sparkSession
    held = _held(spark, path, run_id)
    fresh = cut_lineage(fresh)
    pairs = fresh.select("name_key", "url_key")
    own = fresh.agg(F.collect_set(_bucket(F.col("url_key"), buckets)), F.collect_set(_bucket(F.col("name_key"), buckets))).first()
    by_name = _read(pairs, path, NAMES, held, set(own[1])).join(_sent(fresh.select("name_key")), "name_key", "left_semi")
    touched = set(own[0]) | _buckets(by_name, "url_key", buckets)

    old = _read(fresh, path, ITEMS, held, touched)
    by_url = old.join(_sent(fresh.select("url_key")), "url_key", "left_semi")
    gone = cut_lineage(by_url.select("name_key", "url_key").unionByName(by_name).distinct())
    stored = finalize_snapshot(fresh)
    kept = old.join(_sent(gone.select("url_key")), "url_key", "left_anti")
    new_today = fresh.join(by_url.select("url_key"), "url_key", "left_anti").count()

    renamed = set(own[1]) | _buckets(gone, "name_key", buckets)
    names = _read(pairs, path, NAMES, held, renamed).join(_sent(gone.select("url_key")), "url_key", "left_anti")
    counts = {ITEMS: _write(kept.unionByName(stored), "url_key", path, ITEMS, run_id, buckets),
              NAMES: _write(names.unionByName(stored.select("name_key", "url_key")), "name_key", path, NAMES, run_id, buckets)}
    for part, anew in ((ITEMS, touched), (NAMES, renamed)):
        held = {k: v for k, v in held.items() if k[0] != part or k[1] not in anew} | {(part, b): (run_id, n) for b, n in counts[part].items()}
    count = sum(n for (part, _), (_, n) in held.items() if part == ITEMS)
    rows = [(run_id, part, b, holder, n, None, None) for (part, b), (holder, n) in sorted(held.items())]
    rows.append((run_id, "run", None, run_id, count, generated_at, new_today))
    spark.createDataFrame(rows, INDEX_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/index/run_id={run_id}")
    return {"count": count, "new_today": new_today}


def bucketed_scan(like: DataFrame, path: str, before: int | None = None) -> DataFrame:
    """S9 of this store: the last snapshot (before run `before`), with the columns of `like`; empty when there is none."""
    return _read(like, path, ITEMS, _held(like.sparkSession, path, before))


def bucketed_stats(spark: SparkSession, path: str) -> DataFrame:
    """K2 of this store: one row per run, read from the indexes."""
    return read_index(spark, path).where("part = 'run'").select("run_id", "generated_at", F.col("rows").alias("count"), "new_today")


def expire_buckets(spark: SparkSession, path: str, keep: int) -> int:
    """Delete indexes but the last `keep`, and the bucket folders that none of those names. Returns the folders deleted."""
    index = read_index(spark, path)
    runs = [r["run_id"] for r in index.select("run_id").distinct().orderBy(F.desc("run_id")).collect()]
    in_use = {(r["part"], r["holder"], r["bucket"]) for r in index.where(F.col("run_id").isin(runs[:keep])).where("part != 'run'").collect()}
    old = index.where(F.col("run_id").isin(runs[keep:]) & (F.col("part") != "run")).select("part", "holder", "bucket").distinct().collect()
    folders = [f"{path}/index/run_id={r}" for r in runs[keep:]]
    folders += [f"{path}/{r['part']}/run_id={r['holder']}/bucket={r['bucket']}" for r in old if (r["part"], r["holder"], r["bucket"]) not in in_use]
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(folders)
