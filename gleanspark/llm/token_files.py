"""Token ids as ORC files (operator 3).

Documents are dealt by ranges of doc_id and sorted before they are encoded, so
the files hold them in ascending order and no text is encoded twice. Integer
columns use ORC's run-length encoding; stripes are small enough to be read by
separate tasks; row indexes and a Bloom filter on doc_id let a reader leave out
stripes and row groups that can't hold what it looks for.

Each row also holds the number of its file (`part`) and how many ids come before
it there (`local_start`), so positions in the whole token stream follow from one
small sum per file. Null ids come first; rows of one id stay, ordered by a hash of
their text. Very long texts are encoded whole, in a slice of their own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.llm.bpe import Encoder, public_pattern
from gleanspark.llm.common import new_folder, sliced, table, tidy

SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"
#: Bytes of text in a range, which makes a file.
RANGE_BYTES = 24 << 20
#: Rows and bytes of text that are encoded at once: the more, the more of their pieces are repeats.
BATCH_ROWS, BATCH_BYTES = 10_000, 16 << 20
#: Bytes of a stripe, rows of a row group, false positives of the Bloom filters.
STRIPE_BYTES, STRIDE_ROWS, BLOOM_FPP = 16 << 20, 1_000, 0.01


def write_tokens(docs: DataFrame, out: str, path: str, pattern: str | None = None, end_id: int | None = None, files: int | None = None) -> None:
    """Encode (doc_id, text) and write ORC files to `out`. end_id, if given, is put after each document; null texts count as empty."""
    pattern = pattern or public_pattern()

    def encode(batches):
        encoder, part, at = Encoder(path, pattern), TaskContext.get().partitionId(), 0
        tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        for batch in sliced(batches, 1, BATCH_ROWS, BATCH_BYTES):
            first = 0
            for ids, bounds in encoder.encode(batch.column(1)):
                n = len(bounds) - 1
                ids = np.insert(ids, np.repeat(bounds[1:], len(tail)), np.tile(tail, n)) if len(tail) else ids
                bounds = bounds + np.arange(n + 1) * len(tail)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), batch.column(0).slice(first, n), pa.array(at + bounds[:-1]), pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ], names=["part", "doc_id", "local_start", "n_tokens", "ids"])
                first, at = first + n, at + int(bounds[-1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # ranges by data: large ones, since the more text a task has, the more of its pieces are repeats
    files = files or -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES) or 1
    # a hash and a row number split what null or repeated ids would send to one range
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    (rows.repartitionByRange(files, *order).sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(tidy(encode), SCHEMA)
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(BLOOM_FPP)).option("orc.create.index", "true")
     .option("orc.row.index.stride", str(STRIDE_ROWS)).option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(out))


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """The rows of the files; filters on doc_id reach the stripes' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(out)


def with_starts(tokens: DataFrame) -> DataFrame:
    """Add start: how many ids come before the document in the whole stream.

    Only one number per file is summed and sent to the tasks. A file is the
    output of one task, so there are as many as the writer was asked for.
    """
    files = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return tokens.join(F.broadcast(files), "part").withColumn("start", F.col("before") + F.col("local_start"))


def ids_crc32(df: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32: unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches):
        for batch in sliced(batches, 3, BATCH_ROWS):
            ids = batch.column(3)
            flat, bounds = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            sums = [zlib.crc32(flat[bounds[i]:bounds[i + 1]].tobytes()) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return df.select("doc_id", "start", "n_tokens", "ids").mapInArrow(tidy(crc), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return ids_crc32(with_starts(read_tokens(spark, out)))
