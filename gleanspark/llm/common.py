"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.session import shared_folder

#: White space that separates words, as a Java and RE2 class body.
SPACE = r"\x20\x09-\x0D"
#: Bytes of text that a task takes apart at once; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20
#: Bytes that may be sent to every task.
BROADCAST_BYTES = 64 << 20


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: computed once, lineage cut, safe from lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of runs of other than white space; null counts 0. No list of the words is made."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " "))
    gaps = F.octet_length(squeezed) - F.octet_length(F.replace(squeezed, F.lit(" "), F.lit("")))
    return F.when(squeezed == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by name, whatever characters the names hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def small(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a written `df`, of about `row_bytes` each, are proven few enough to send to every task."""
    return df.count() * row_bytes <= max_bytes


def one_of_each(docs: DataFrame, name: Column, members: DataFrame, member: str) -> DataFrame:
    """The rows of `docs` whose `name` stays, one of each name.

    members: `member` (a name), stays, rows. Only names that go or have several rows
    are looked up. They are sent to the tasks if they are proven few, so that
    texts don't move; else texts are shuffled once.
    """
    marks = written(members.filter("not stays or rows > 1").select(member, "stays"), "marks")
    if small(marks, 128):
        marks = F.broadcast(marks)
    stays = free_name(docs, "stays")
    marked = docs.withColumn(member, name).join(marks.withColumnRenamed("stays", stays), member, "left")
    single = marked.filter(F.col(stays).isNull())
    repeated = marked.filter(F.col(stays)).dropDuplicates([member])
    return single.unionByName(repeated).select(*quoted(docs.columns))


def sliced(batches: Iterator[pa.RecordBatch], column: int, rows: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows` rows and about `size` bytes (or values of its lists) in `column`.

    Copied: Arrow's ascii_lower misreads large strings in a view that starts past the first row.
    """
    for batch in batches:
        length = pc.list_value_length if pa.types.is_list(batch.schema.field(column).type) else pc.binary_length
        total = np.cumsum(pc.fill_null(length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right"))
            end = min(at + rows, max(at + 1, fits), batch.num_rows)
            yield batch.take(pa.array(range(at, end)))
            at = end


def give_back() -> None:
    """Hand the memory that a task no longer needs back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`task`, a function from batches to batches, that gives memory back when it ends."""

    def run(batches):
        yield from task(batches)
        give_back()

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit integers (the finish of splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text i has the words hashes[bounds[i]:bounds[i + 1]], 64 bits each. A-Z count as a-z; null is empty."""
    from xxhash import xxh64_intdigest

    lower = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    lists = pc.split_pattern_regex(lower, f"[{SPACE}]+").cast(pa.large_list(pa.large_string()))
    flat = lists.flatten().dictionary_encode()
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    index = flat.indices.to_numpy(zero_copy_only=False)
    names = flat.dictionary.to_pylist()
    # white space at either end of a text leaves empty strings
    real = np.array([bool(w) for w in names], dtype=bool)[index] if names else np.zeros(0, dtype=bool)
    before = np.concatenate([[0], np.cumsum(real)])
    hashes = np.array([xxh64_intdigest(w) for w in names], dtype=np.uint64)
    return hashes[index[real]], before[ends].astype(np.int64)
