"""Toxicity grades by cumulative-link ordinal regression (operator 2).

P(grade <= k) = logistic(threshold_k - w.x): one weight vector for all ordered
thresholds. x says which words of a vocabulary a text holds. The expected
severity is the sum over grades of k P(grade = k).

The model is fitted on at most MAX_ROWS labelled rows (those with the smallest
hash of their id) and a vocabulary of at most MAX_WORDS words; both bound what is
gathered in one task and what is sent to all tasks, at any size of the input.
Scoring reads every whole text.

Null and empty texts have no words. Labels null or without a text are left out.
Without any labels the severity of all is 0 and nothing is rejected; with labels
of one grade, that grade is the severity of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import free_name, give_back, quoted, sliced, table, tidy, written

MAX_ROWS, MAX_WORDS, MIN_ROWS_OF_WORD, MAX_WORD_BYTES = 16_000, 30_000, 5, 40
#: Tasks that read the training rows.
TRAINING_PARTS = 12
#: Texts whose words are listed at once.
SLICE_ROWS = 1_000
#: Strength of the pull of weights towards zero, per row.
RIDGE = 2e-4
#: Least expected severity of a rejected text.
REJECT_FROM = 0.5

_APART = r"[\s\x0b.,;:!?\"'()\[\]{}<>]+"


@dataclass
class Model:
    """words in byte order, a weight each, and thresholds between grades."""

    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k) by row and k."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))], axis=1), axis=1)


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, word) for each word of each text: ASCII lower case, cut at white space and punctuation."""
    lower = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    lists = pc.split_pattern_regex(lower, _APART).cast(pa.large_list(pa.large_string()))
    flat = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return np.repeat(np.arange(len(texts)), np.diff(bounds)), flat


def present(texts: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, index in words) of the distinct words of each text that are in `words`."""
    row, flat = words_of(texts)
    place = pc.index_in(flat.dictionary, value_set=words.cast(pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False)
    if not len(row):
        return row, row
    at = place[flat.indices.to_numpy(zero_copy_only=False)]
    pair = np.unique(row[at >= 0] * len(words) + at[at >= 0])
    return pair // max(1, len(words)), pair % max(1, len(words))


def fit_ordinal(row: np.ndarray, col: np.ndarray, grade: np.ndarray, n_words: int, ridge: float = RIDGE, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by L-BFGS on the mean negative log-likelihood. Threshold gaps are exponentials, so they stay in order."""
    n, top = len(grade), int(grade.max())

    def thresholds(p):
        return p[n_words] + np.concatenate([[0], np.cumsum(np.exp(p[n_words + 1:]))])

    def loss(p):
        w, t = p[:n_words], thresholds(p)
        score = np.bincount(row, w[col], minlength=n)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        f = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
        up, low = f(edges[grade + 1] - score), f(edges[grade] - score)
        p_row = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p_row, low * (1 - low) / p_row
        by_row = (d_up - d_low) / n  # derivative of the loss by the score
        d_t = np.array([(-(d_up[grade == k]).sum() + d_low[grade == k + 1].sum()) / n for k in range(top)])
        gap = np.exp(p[n_words + 1:])
        tail = np.cumsum(d_t[::-1])[::-1]
        small = 1e-4 * p[n_words + 1:]  # an empty grade has no pull of its own
        return (-np.log(p_row).mean() + ridge / 2 * (w @ w) + 0.5e-4 * (p[n_words + 1:] @ p[n_words + 1:]),
                np.concatenate([np.bincount(col, by_row[row], minlength=n_words) + ridge * w, [tail[0]], tail[1:] * gap + small]))

    p = np.zeros(n_words + top)
    share = np.clip((grade == 0).mean(), 1e-3, 1 - 1e-3)
    p[n_words] = np.log(share / (1 - share))
    value, slope = loss(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d = -slope
        alphas = []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            alphas.append(a)
            d = d - a * y
        if past:
            s, y = past[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(alphas), strict=True):
            d = d + s * (a - (y @ d) / (s @ y))
        size = 1.0
        while size > 1e-10:
            there, new = loss(p + size * d)
            if there <= value + 1e-4 * size * (slope @ d):
                break
            size /= 2
        else:
            break
        s, y = size * d, new - slope
        done = value - there < 1e-7
        p, value, slope = p + s, there, new
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y)]
        if done:
            break
    return p[:n_words], thresholds(p)


def severity_labels(row: np.ndarray, col: np.ndarray, toxic: np.ndarray, n_words: int) -> np.ndarray:
    """Grades 0, 1, 2 from 0/1 labels: a toxic row is 2 if it holds more abusive words than the median toxic row.

    Abusive are words ten times as frequent among toxic rows as among others.
    """
    is_toxic = toxic > 0
    in_toxic, in_clean = (np.bincount(col[m[row]], minlength=n_words) for m in (is_toxic, ~is_toxic))
    often = (in_toxic + 0.5) / (is_toxic.sum() + 1) >= 10 * (in_clean + 0.5) / ((~is_toxic).sum() + 1)
    held = np.bincount(row, often[col], minlength=len(toxic)) if len(row) else np.zeros(len(toxic))
    middle = np.median(held[is_toxic]) if is_toxic.any() else 0
    return np.where(is_toxic, 1 + (held > middle), 0).astype(np.int64)


def fit(labelled: DataFrame, from_binary: bool = True, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> Model:
    """Fit on (id, text, grade); from_binary turns grades of 0 and 1 into 0, 1 and 2 first."""
    sample = written(labelled.filter("grade is not null").orderBy(F.xxhash64("id"), "id", "grade").limit(max_rows).repartition(TRAINING_PARTS, "id"), "labelled")
    spark = sample.sparkSession

    def distinct(batches):
        for batch in sliced(batches, 0, SLICE_ROWS):
            row, flat = words_of(batch.column(0))
            pair = np.unique(row * max(1, len(flat.dictionary)) + flat.indices.to_numpy(zero_copy_only=False)) if len(row) else row
            count = np.bincount(pair % max(1, len(flat.dictionary)), minlength=len(flat.dictionary))
            yield pa.RecordBatch.from_arrays([flat.dictionary.cast(pa.string()), pa.array(count, pa.int64())], names=["word", "n"])

    counted = (sample.select("text").mapInArrow(tidy(distinct), "word string, n long").filter(f"word != '' and octet_length(word) <= {MAX_WORD_BYTES}")
               .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_ROWS_OF_WORD))
    words = sorted((r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(max_words).collect()), key=str.encode)
    known = pa.array(words, pa.string())

    def features(batches):
        for batch in sliced(batches, 0, SLICE_ROWS):
            row, col = present(batch.column(0), known)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(pa.array(bounds), pa.array(col, pa.int32()))], names=["grade", "cols"])

    def train(pdf):
        cols = [np.asarray(c, dtype=np.int64) for c in pdf["cols"]]
        row, col = np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate([np.zeros(0, np.int64), *cols])
        grade = pdf["grade"].to_numpy().astype(np.int64)
        if from_binary:
            grade = severity_labels(row, col, grade, len(words))
        if grade.max() == grade.min():
            w, t = np.zeros(len(words)), np.repeat([-50.0, 50.0], [grade.min(), 1])
        else:
            w, t = fit_ordinal(row, col, grade, len(words))
        return pd.DataFrame({"w": [w.astype("<f8").tobytes()], "t": [t.astype("<f8").tobytes()]})

    found = (sample.select("text", F.col("grade").cast("int").alias("grade")).mapInArrow(tidy(features), "grade int, cols array<int>")
             .groupBy().applyInPandas(train, "w binary, t binary").collect())
    if not found:
        return Model([], np.zeros(0), np.array([50.0]))
    return Model(words, np.frombuffer(found[0]["w"], "<f8"), np.frombuffer(found[0]["t"], "<f8"))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column, severity (expected grade) and grade (the most likely one), for every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.thresholds))

    def run(batches):
        words, weights, thresholds = sent.value
        known, m = pa.array(words, pa.string()), Model(words, weights, thresholds)
        for batch in sliced(batches, 1, SLICE_ROWS):
            row, col = present(batch.column(1), known)
            p = m.grades(np.bincount(row, weights[col], minlength=batch.num_rows) if len(row) else np.zeros(batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(axis=1).astype(np.int32))], names=["id", "severity", "grade"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(run), f"id {dict(rows.dtypes)['id']}, severity double, grade int").withColumnRenamed("id", id_column)


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, grade) of the documents that labels cover; grade is their toxic label."""
    return docs.select(F.col("doc_id").alias("id"), "text").join(labels.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("grade")), "id")


def sampled_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The labels that fit() may use, chosen before any text is read, so that only their texts move."""
    return labels.filter("doc_id is not null and toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows)


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, grade, rejected for every row of `docs`."""
    few = written(sampled_labels(labels), "labels")
    model = fit(labelled_documents(docs.join(F.broadcast(few.select("doc_id").distinct()), "doc_id", "left_semi"), few))
    return score(docs, model).withColumn("rejected", F.col("severity") >= REJECT_FROM)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without those whose expected severity is at least REJECT_FROM. Labels teach the model and decide nothing else."""
    few = written(sampled_labels(labels), "labels")
    model = fit(labelled_documents(docs.join(F.broadcast(few.select("doc_id").distinct()), "doc_id", "left_semi"), few))
    severity = free_name(docs, "severity")
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.thresholds))

    @F.arrow_udf("double")
    def expected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, weights, thresholds = sent.value
        known, model_ = pa.array(words, pa.string()), Model(words, weights, thresholds)
        for texts in batches:
            out = [np.zeros(0)]
            for batch in sliced([pa.RecordBatch.from_arrays([texts], names=["text"])], 0, SLICE_ROWS):
                row, col = present(batch.column(0), known)
                p = model_.grades(np.bincount(row, weights[col], minlength=batch.num_rows) if len(row) else np.zeros(batch.num_rows))
                out.append(p @ np.arange(p.shape[1]))
            yield pa.array(np.concatenate(out))
        give_back()

    return docs.withColumn(severity, expected(F.col("text"))).filter(F.col(severity) < REJECT_FROM).select(*quoted(docs.columns))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
