"""Tables of terms: which of them a text holds, however many there are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import WORD
from ..session import cut_lineage
from .skew import HOT_ROWS, ROW_OVERHEAD, balanced_join

#: Terms up to this size are sent to the tasks, which need some forty bytes a character to hold them ready.
AUTOMATON_BYTES = 4 << 20
RUNS_AT_ONCE = 50_000


def _word_test() -> Callable[[str, int, int], bool]:
    """Whether text[start:end] has no letter or digit right before or after it."""
    import regex

    word = regex.compile(f"[{WORD}]")
    return lambda text, start, end: not (start and word.match(text[start - 1])) and not (end < len(text) and word.match(text[end]))


def _finder(terms: Sequence[tuple[str, int, str]], limit: int | None, whole_word: bool) -> Callable[[str | None], list[str]]:
    """The labels of a text, from one pass over it."""
    from ahocorasick import Automaton

    automaton, whole, of = Automaton(), _word_test(), {}
    for term, rank, label in terms:
        of.setdefault(term, []).append((rank, label))
    for term, labels in of.items():
        automaton.add_word(term, (len(term), labels))
    automaton.make_automaton()

    def find(text: str | None) -> list[str]:
        if not text or not of:
            return []
        found = set()
        for last, (length, labels) in automaton.iter(text):
            if not whole_word or whole(text, last + 1 - length, last + 1):
                found.update(labels)
        return list(dict.fromkeys(label for _, label in sorted(found)))[:limit]

    return find


def _runs(lengths: Sequence[int], whole_word: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(at, term): each text's distinct runs of characters of the given lengths, some at once."""

    def run(batches):
        whole, names, runs = _word_test(), [], []
        for batch in batches:
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for n in lengths:
                    own = {text[i:i + n] for i in range(len(text) - n + 1) if not whole_word or whole(text, i, i + n)}
                    names += [at] * len(own)
                    runs += own
                    if len(runs) >= RUNS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(runs, pa.string())], names=["at", "term"])
                        names, runs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(runs, pa.string())], names=["at", "term"])

    return run


def _joined(rows: DataFrame, text: Column, terms: DataFrame, name: str, limit: int | None, whole_word: bool, hot_rows: int) -> DataFrame:
    at = "text_sha256"
    while at in {c.lower() for c in rows.columns}:
        at += "_"
    keyed = rows.withColumn(at, F.sha2(text, 256))
    texts = rows.select(F.sha2(text, 256).alias("at"), text.alias("text")).where("text is not null").dropDuplicates(["at"])
    # one number per length, as many as the longest term has characters at most
    lengths = sorted(row[0] for row in terms.select(F.length("term")).distinct().collect())
    runs = cut_lineage(texts.mapInArrow(_runs(lengths, whole_word), "at string, term string"))
    pairs = balanced_join(runs, terms, ["term"], "inner", hot_rows)
    labels = F.array_distinct(F.transform(F.array_sort(F.collect_set(F.struct("rank", "label"))), lambda x: x["label"]))
    found = pairs.groupBy("at").agg((labels if limit is None else F.slice(labels, 1, limit)).alias(name)).withColumnRenamed("at", at)
    return balanced_join(keyed, found, [at], "left", hot_rows).withColumn(name, F.coalesce(name, F.array().cast("array<string>"))).drop(at)


def with_labels(
    rows: DataFrame, text: Column, terms: DataFrame, name: str = "labels", limit: int | None = None, whole_word: bool = False,
    max_bytes: int = AUTOMATON_BYTES, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`rows` with the array `name`: the labels of the terms that `text` holds, each once, by (rank, label), at most `limit`.

    terms: (term, rank, label); a term may have several labels. Empty terms and
    rows with a null take no part. Case counts: pass both in lower case for any
    case. A null text has no labels. `name` must be new to `rows`.

    Terms that are proven small go to every task as one automaton, which reads
    a text once however many there are. Larger tables are joined: each distinct
    text sends its runs of characters that are as long as some term, so nothing
    grows with the number of terms but the table itself.
    """
    known = cut_lineage(terms.where("term <> ''").select("term", F.col("rank").cast("bigint").alias("rank"), F.col("label").cast("string").alias("label")).dropna().distinct())
    size = known.agg(F.sum(F.octet_length("term") + F.octet_length("label") + F.lit(ROW_OVERHEAD))).first()[0] or 0
    if size > max_bytes:
        return _joined(rows, text, known, name, limit, whole_word, hot_rows)
    sent = rows.sparkSession.sparkContext.broadcast([tuple(row) for row in known.select("term", "rank", "label").collect()])

    def labels(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = _finder(sent.value, limit, whole_word)
        for some in texts:
            yield pd.Series([find(t) for t in some], dtype=object)

    return rows.withColumn(name, F.pandas_udf(labels, "array<string>")(text))


def guess_categories_table(rows: DataFrame, text: Column, terms: DataFrame, name: str = "categories", limit: int | None = None, **kw) -> DataFrame:
    """P3 with a table (term, rank, label): categories with a whole-word hit in any case, by rank."""
    low = terms.withColumn("term", F.lower("term"))
    return with_labels(rows, F.lower(text), low, name, limit, whole_word=True, **kw)


def blocklist_contains_table(links: DataFrame, blocklist: DataFrame, href: str = "href", **kw) -> DataFrame:
    """J6 in its contains form with a table (domain): links whose url, in any case, holds none of them. A null url stays."""
    terms = blocklist.select(F.lower("domain").alias("term"), F.lit(0).alias("rank"), F.lit("").alias("label"))
    hits = "hits"
    while hits in {c.lower() for c in links.columns}:
        hits += "_"
    return with_labels(links, F.lower(F.col(href)), terms, hits, 1, **kw).where(F.size(hits) == 0).drop(hits)
