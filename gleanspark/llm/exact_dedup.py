"""Exact dedup with a heavy-hitter split (operator 7).

Texts are equal when identical after each run of white space became one space;
null counts as empty. Misra-Gries summaries, one per task and merged in groups,
name the few digests that may be frequent. Their true sizes and winners are
counted, and broadcast, so that rows of large groups never move. All other
digests are shuffled as usual: none of them is in more than about 1/counters of
the rows.

The row with the smallest doc_id of a group stays; null ids come last. Of rows
that also share the doc_id, one stays. Very long texts are hashed whole. An empty
table gives an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import SPACE, free_name, one_of_each, quoted, table, written

#: Counters of a summary: a digest in more than 1/COUNTERS of the rows is certain to be named, and no more than COUNTERS are.
COUNTERS = 1_000
#: Summaries merged by one task.
FAN_IN = 64


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " "), 256)


def _shrunk(counts: pd.Series, counters: int) -> pd.Series:
    """Misra-Gries: at most `counters` counts, each too low by no more than rows/counters."""
    if len(counts) <= counters:
        return counts
    counts = counts - counts.nlargest(counters + 1).iloc[-1]
    return counts[counts > 0]


def heavy_hitters(keys: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` values of `column`, among them all that are in more than 1/counters of the rows. Nulls are left out."""

    def summary(batches):
        counts = pd.Series(dtype="int64")
        for pdf in batches:
            counts = _shrunk(counts.add(pdf["k"].dropna().value_counts(), fill_value=0), counters)
        yield pd.DataFrame({"at": TaskContext.get().partitionId(), "k": counts.index.astype(str), "n": counts.to_numpy().astype("int64")})

    def merged(pdf):
        counts = _shrunk(pdf.groupby("k")["n"].sum(), counters)
        return pd.DataFrame({"at": int(pdf["at"].iloc[0]) // FAN_IN, "k": counts.index, "n": counts.to_numpy()})

    schema = "at int, k string, n long"
    tasks = keys.rdd.getNumPartitions()
    found = keys.select(F.col(column).alias("k")).mapInPandas(summary, schema)
    while tasks > 1:
        found = found.groupBy((F.col("at") / FAN_IN).cast("int").alias("g")).applyInPandas(merged, schema)
        tasks = -(-tasks // FAN_IN)
    return found.select(F.col("k").alias(column), F.col("n").alias("at_least"))


def group_members(keys: DataFrame, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """From written (row, doc_id, digest), `row` unique: (members, winners).

    members: one row per row, with keep_id, group_size and kept. winners: those of
    the frequent digests, at most `counters` rows: digest, keep_id, keep_row,
    group_size. Counting combines in each task, so that of frequent digests only
    sums are shuffled.
    """
    frequent = written(heavy_hitters(keys, "digest", counters), "frequent")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    total = [first, F.count("*").alias("group_size")]
    named = ["digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"]
    winners = written(keys.join(F.broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(*total).select(*named), "winners")
    large = keys.join(F.broadcast(winners), "digest")
    rest = keys.join(F.broadcast(frequent), "digest", "left_anti")
    small = rest.join(rest.groupBy("digest").agg(*total).select(*named), "digest")
    members = large.unionByName(small).select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")
    return members, winners


def document_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, doc_id, digest) of every row, written: `row` numbers them once and for all."""
    id_, text = quoted([id_column, text_column])
    return written(docs.select(F.monotonically_increasing_id().alias("row"), id_.alias("doc_id"), text_digest(text).alias("digest")), "digests")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS) -> DataFrame:
    """`docs` with one row of each group of equal texts.

    Rows of frequent texts go where they are read, told by the broadcast winners.
    """
    digest, member, keep = (free_name(docs, n) for n in ("digest", "member", "keep_id"))
    id_, text = quoted([id_column, text_column])
    members, winners = group_members(document_digests(docs, id_column, text_column), counters)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rare = members.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    losers = rare.filter(~stays).groupBy("doc_id", "digest").agg(F.lit(False).alias("stays"), F.count("*").alias("rows"))
    winning = members.filter(stays).groupBy("doc_id", "digest").agg(F.lit(True).alias("stays"), F.count("*").alias("rows"))
    marks = losers.unionByName(winning).select(F.struct("doc_id", "digest").alias(member), "stays", "rows")
    hot = F.broadcast(winners.select(F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.lit(True).alias(member)))
    fewer = docs.withColumn(digest, text_digest(text)).join(hot, digest, "left").filter(F.col(member).isNull() | id_.eqNullSafe(F.col(keep))).drop(member, keep)
    return one_of_each(fewer, F.struct(id_.alias("doc_id"), F.col(digest).alias("digest")), marks, member).select(*quoted(docs.columns))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = group_members(document_digests(table(spark, sf_dir, "documents")))
    return members.drop("row").withColumnRenamed("digest", "text_sha256")


OP7_SQL = r"""
WITH k AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM k GROUP BY text_sha256)
SELECT k.doc_id, g.keep_id, g.group_size, k.doc_id = g.keep_id AS kept, k.text_sha256 FROM k JOIN g USING (text_sha256)
"""
