"""Mixing sources to target weights by systematic sampling (operator 5).

A source's target over its size is what each of its documents is expected to be
copied. The documents of a source stand in order of size, their expected copies
are summed up along it, one random offset per source is added, and a document is
taken once for each integer boundary that its own stretch crosses. Neighbours in
the order have nearly the same size, so the words taken stay within about two
long documents of the target.

The prefix sum is made in two steps over ranges of (source, size, doc_id), so a
source that holds a third of all rows is spread over tasks like any other.
Sources are few (weights are given by their order), so one row per source is
sorted in one task and sent to all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import free_name, quoted, table, word_count, written

WEIGHTS = (1, 2, 3)
MOST = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, weight, target from (source, size).

    Sources by code point, null last, take `weights` in turn. Targets share the
    sum of all sizes by weight and stop at `most` times the source's size; what is
    above goes to the others by weight. That is min(level * weight, most * size)
    for one level: sources in order of size/weight are full up to some place.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), F.col("place"))
    before, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("place", F.row_number().over(order) - 1)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
            .withColumn("cap", most * F.col("source_size")))
    rows = (rows.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
            .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
            # the level if this source and all after it weren't full
            .withColumn("here", (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
            .withColumn("full", F.col("cap") <= F.col("here") * F.col("weight")))
    level = F.min(F.when(~F.col("full"), F.struct("cap_before", F.col("here").alias("level")))).over(everything)["level"]
    return rows.withColumn("level", level).select(
        "source", "source_size", "weight",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def source_offset(source: Column, seed: int) -> Column:
    """The source's offset in [0, 1), the same in each run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)


def copies(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, parts: int | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken, a row per row of (doc_id, source, size).

    Ids may be null or repeated; rows that share source, size and id are alike.
    A source without words has target 0 and isn't taken.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(docs.select("doc_id", "source", "size"), "sizes")
    targets = written(source_targets(rows, weights, most), "targets")
    by_source = F.col("source").cast("binary")
    dealt = rows.repartitionByRange(parts, F.coalesce(by_source, F.lit(b"")), F.col("source").isNull(), "size", "doc_id").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    in_part = Window.partitionBy("part", "source").orderBy("size", "doc_id")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("source", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    known = firsts.alias("f").join(F.broadcast(targets.alias("t")), F.col("f.source").eqNullSafe(F.col("t.source"))).select(
        F.col("f.source").alias("of"), F.col("f.part").alias("in"), "before", "source_size", "target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = (dealt.withColumn("row", F.row_number().over(in_part))
              .join(F.broadcast(known), (F.col("part") == F.col("in")) & F.col("source").eqNullSafe(F.col("of")))
              .withColumn("place", F.col("before") + F.col("row")).withColumn("each", each).withColumn("offset", source_offset(F.col("source"), seed)))
    crossed = F.floor(F.col("offset") + F.col("each") * F.col("place")) - F.floor(F.col("offset") + F.col("each") * (F.col("place") - 1))
    return (placed.withColumn("copies", F.least(crossed, F.lit(most)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: int = 7, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """`docs` as the mix takes them: each row as often as it is taken, so some not at all."""
    size, row, again = free_name(docs, "size"), free_name(docs, "row"), free_name(docs, "again")
    sized = docs.withColumn(size, word_count(F.col(text_column)))
    taken = copies(sized.select(F.col(id_column).cast("string").alias("doc_id"), F.col(source_column).alias("source"), F.col(size).alias("size")), seed)
    # rows that share id, source and size are told apart by number
    key = lambda i, s, n: F.struct(F.coalesce(F.concat(F.lit("s"), i), F.lit("")), F.coalesce(F.concat(F.lit("s"), s), F.lit("")), n)
    wanted = taken.groupBy(key(F.col("doc_id"), F.col("source"), F.col("size")).alias("k")).agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias("each"), F.count("*").alias("rows")).filter("each[0] > 0")
    left = docs.select(F.struct(*quoted(docs.columns)).alias(row), key(F.col(id_column).cast("string"), F.col(source_column), word_count(F.col(text_column))).alias(again))
    joined = left.join(wanted, F.col(again) == F.col("k"))
    single = joined.filter("rows = 1").withColumn("n", F.col("each")[0])
    # repeated rows: each takes one number of the list
    numbered = joined.filter("rows > 1").withColumn("n", F.col("each")[F.row_number().over(Window.partitionBy("k").orderBy(F.xxhash64(row))) - 1]).filter("n > 0")
    return single.unionByName(numbered).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(f"{row}.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return copies(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


OP5_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM sizes GROUP BY source
), weighed AS (
  SELECT *, (place % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap FROM sums
), stood AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighed WINDOW w AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (total - cap_before)::DOUBLE / (all_weight - weight_before)::DOUBLE AS here FROM stood
), filled AS (
  SELECT *, cap <= here * weight AS is_full FROM levels
), one AS (
  SELECT arg_min(here, cap_before) AS level FROM filled WHERE NOT is_full
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE least(level * weight, cap::DOUBLE) END AS target,
    ('0x' || substr(md5('7:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM filled LEFT JOIN one ON true
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS place
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, least(floor(u + each * place) - floor(u + each * (place - 1)), 3)::BIGINT AS copies FROM placed
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM taken
"""
