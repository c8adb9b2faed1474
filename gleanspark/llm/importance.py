"""Importance resampling towards a target distribution (operator 13).

Words and runs of words are hashed into buckets. A bucket's gain is the logarithm
of how much more of the target texts than of all documents it holds; a document's
weight is the mean gain of its features, and a draw without replacement adds
Gumbel noise, fixed by the document's id, to the weights.

A batch's texts are joined with separators into one string, and one pass of a
regular expression finds all its words; searching their places among the
documents' offsets tells which runs stay inside a document. The features are
counted per document and, for the totals, per batch before anything is shuffled.

Null and empty texts have no features and weight 0. Rows of one id share their
noise, rows without an id that of the empty id; they are drawn like others, null
ids last among equal scores. A very long text makes a batch of its own, whose
features are counted in pieces.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import sliced, table, tidy, written
from gleanspark.operators.order import with_position

#: Buckets of the features; the totals and the gains hold one number for each.
BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 1
#: Documents with fewer words aren't drawn; of the others, this share in percent is.
LEAST_WORDS, PERCENT = 20, 10
SEED = 2024
#: A gain, weight or noise of 1.
UNIT = 1_000
ROWS_AT_ONCE = 5_000

# runs of a-z, 0-9 and all that isn't ASCII, over UTF-8 bytes
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FEATURES = "id {0}, n_words long, n_features long, buckets array<int>, times array<int>, totals array<long>"


def batch_features(texts: list[str | None], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n_words, doc, bucket): words of each text, and document and bucket of each feature."""
    parts = [(t or "").encode().lower() for t in texts]
    joined = b"\n".join(parts)
    starts = np.cumsum([0, *[len(p) + 1 for p in parts]])
    del parts
    spans = [m.span() for m in _WORD.finditer(joined)]
    doc = np.searchsorted(starts, np.fromiter((a for a, _ in spans), np.int64, len(spans)), side="right") - 1
    words = [joined[a:b] for a, b in spans]
    sums = [zlib.crc32(w) for w in words]
    docs, found = [doc], [np.array(sums, dtype=np.int64)]
    for n in range(1, longest):
        # the run that starts at word i goes on with word i + n; those that leave the document are masked
        sums = [zlib.crc32(w, zlib.crc32(b" ", s)) for s, w in zip(sums, words[n:], strict=False)]
        inside = doc[:len(sums)] == doc[n:n + len(sums)]
        docs.append(doc[:len(sums)][inside])
        found.append(np.array(sums, dtype=np.int64)[inside])
    return np.bincount(doc, minlength=len(texts)), np.concatenate(docs), np.concatenate(found) % buckets


def features(texts: DataFrame, id_column: str | None, text_column: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words, n_features, the buckets a text's features are in and how many are in each; totals: one row of a batch
    has the sums over the batch, the others null."""

    def run(batches):
        for batch in sliced(batches, 1, ROWS_AT_ONCE):
            rows = batch.num_rows
            n_words, doc, bucket = batch_features(batch.column(1).to_pylist(), longest, buckets)
            cells, times = np.unique(doc * buckets + bucket, return_counts=True)
            bounds = np.searchsorted(cells, np.arange(rows + 1) * buckets)
            lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x.astype(np.int32))) for x in (cells % buckets, times)]
            totals = pa.array([np.bincount(bucket, minlength=buckets)] + [None] * (rows - 1), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(np.bincount(doc, minlength=rows)), *lists, totals],
                                             names=["id", "n_words", "n_features", "buckets", "times", "totals"])

    own = F.lit(0).cast("long") if id_column is None else F.col(id_column)
    rows = texts.select(own.alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(run), _FEATURES.format(dict(rows.dtypes)["id"]))


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows: one number per bucket comes to the driver."""
    sums = found.filter("totals is not null").select(F.posexplode("totals").alias("bucket", "n")).filter("n > 0")
    out = np.zeros(buckets, dtype=np.int64)
    for r in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray, unit: int = UNIT) -> list[int]:
    """Per bucket, the floored logarithm of the smoothed share in the target over that in the source, in 1/unit."""
    b, t_all, s_all = len(source), int(target.sum()), int(source.sum())
    return [math.floor(unit * math.log((int(t) + 1) * (s_all + b) / ((int(s) + 1) * (t_all + b)))) for t, s in zip(target, source, strict=True)]


def noise(doc_id: Column, seed: int = SEED, unit: int = UNIT) -> Column:
    """Gumbel noise in 1/unit, floored, from the first 32 bits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-float(unit) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST,
             buckets: int = BUCKETS, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column, n_features, weight, score and rank of every row; rank is null where the row isn't drawn."""
    found = written(features(docs, id_column, text_column, longest, buckets), "features")
    # the target is read once, for its sums alone
    wanted = totals(features(target, None, text_column, longest, buckets), buckets)
    gain = docs.sparkSession.sparkContext.broadcast(np.array(gains(wanted, totals(found, buckets)), dtype=np.int64))

    def weigh(batches):
        for batch in sliced(batches, 3, 100_000):
            bounds = batch.column(3).offsets.to_numpy().astype(np.int64)
            bucket, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
            sums = np.concatenate([[0], np.cumsum(gain.value[bucket] * times)])
            bounds -= bounds[0]
            n = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array((sums[bounds[1:]] - sums[bounds[:-1]]) // np.maximum(n, 1))],
                                             names=["id", "n_words", "n_features", "weight"])

    id_type = dict(found.dtypes)["id"]
    weighed = found.select("id", "n_words", "n_features", "buckets", "times").mapInArrow(tidy(weigh), f"id {id_type}, n_words long, n_features long, weight long")
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    able = scored.filter(F.col("n_words") >= least_words)
    placed = with_position(able, [F.desc("score"), F.asc_nulls_last("id")], "rank", first=1)
    drawn = able.count() * percent // 100
    ranked = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 of a word's bytes by its usual table, itself worked out by the eight shifts of each entry
OP13_SQL = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), texts AS (
  SELECT doc_id, true AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL
  SELECT item_id, false, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), found AS (
  SELECT doc_id, source, unnest(words) AS word FROM texts
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(hex(encode(word))) // 2), lambda i: ('0x' || substr(hex(encode(word)), 2 * i::INT + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM found), steps
), counts AS (
  SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM found JOIN hashed USING (word) GROUP BY bucket
), sums AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain FROM counts, sums
), weights AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM found JOIN hashed USING (word) JOIN gains USING (bucket) WHERE source GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank FROM scored s LEFT JOIN placed USING (doc_id)
"""
