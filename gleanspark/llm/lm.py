"""Language-model scores by deleted interpolation (operator 9).

p(w | h) = a_b c(h, w) / c(h) + b_b c(w) / N + c_b / (V + 1), with weights by the
bucket b of the context's frequency c(h), learned by expectation-maximisation on
one fold of the learning texts that the counts leave out; the scores then use the
counts of all learning texts. c_b also covers words never seen.

Texts are read in blocks, a few million words each. A block's words become
numbers of its own, and its distinct words and pairs of words (64-bit hashes,
told apart up to chance collisions of about n^2 / 2^65) are sent out once per
block, in sorted runs dealt by hash. So a pair that fills the corpus arrives once
per block, not once per use. What comes back to a block are the totals of its own
words and pairs, beside the numbered texts that it wrote.

Null texts are empty: one end token. Rows without an id take no part in learning
and are scored as held out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import SPACE, table, written

#: About how many tokens a block has, and how many tokens of the corpus there are for each counting group.
BLOCK_TOKENS, GROUP_TOKENS = 1_500_000, 750_000
FOLDS, HELD_OUT, EM_FOLD = 10, 0, 1
#: Context frequencies up to 2^0, 2^1, ... fall into buckets 1, 2, ...; contexts without a count into 0.
BUCKETS = 24
EM_ROUNDS = 12
SMOOTHING = 0.1
END = np.uint64(0x9AE16A3B2F90404F)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def fold_of(doc_id) -> int:
    return zlib.crc32(str(int(doc_id)).encode()) % FOLDS


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair of word hashes."""
    h = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + np.uint64(0x632BE59BD9B4E019))
    h = (h ^ h >> np.uint64(30)) * _M1
    h = (h ^ h >> np.uint64(27)) * _M2
    return h ^ h >> np.uint64(31)


def packed(a: np.ndarray, ordered: bool = False) -> bytes:
    """Integers as bytes, all first bytes first, compressed; ordered ones as differences."""
    import zstandard

    a = np.diff(a, prepend=a.dtype.type(0)) if ordered else a
    return zstandard.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, dtype: str, ordered: bool = False) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    a = np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)
    return np.cumsum(a, dtype=dtype) if ordered else a


@dataclass
class Block:
    """Texts as numbers: doc i has tokens[bounds[i]:bounds[i + 1]], the last one its end; words[tokens] are word hashes, in order."""

    tokens: np.ndarray
    bounds: np.ndarray
    words: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct pair keys in order, for each token the index of the pair that ends in it). A text's first word follows an end."""
        h = self.words[self.tokens]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.bounds[:-1]] = END
        keys, index = np.unique(pair_keys(before, h), return_inverse=True)
        return keys, index


def numbered(texts: pa.Array) -> Block:
    """Words of all texts, hashed and numbered; equal words share a number."""
    from xxhash import xxh64_intdigest

    lower = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    lists = pc.split_pattern_regex(lower, f"[{SPACE}]+").cast(pa.large_list(pa.large_string()))
    flat = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    index = flat.indices.to_numpy(zero_copy_only=False)
    names = flat.dictionary.to_pylist()
    # white space at either end of a text leaves empty strings
    real = np.array([bool(w) for w in names], dtype=bool)[index] if len(names) else np.zeros(0, dtype=bool)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))[real]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)) + 1)
    words, place = np.unique(np.array([END, *[xxh64_intdigest(w) for w in names]], dtype=np.uint64), return_inverse=True)
    tokens = np.full(int(ends[-1]) if len(ends) else 0, place[0], dtype=np.int32)
    filled = np.ones(len(tokens), dtype=bool)
    filled[ends - 1] = False
    tokens[filled] = place[1:][index[real]]
    return Block(tokens, np.concatenate([[0], ends]), words)


BLOCKS = "block string, em boolean, n long, n_learned long, n_em long, doc_ids array<long>, folds binary, lengths binary, tokens binary, words binary"
RUNS = "block string, kind int, slot int, keys binary, counts binary, held binary"
TOTALS = "block string, kind int, slot int, counts binary, held binary, new long"


def read_blocks(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts in blocks of about BLOCK_TOKENS, numbered. Texts of the EM fold have blocks of their own.

    A block's name tells the task and its place in it.
    """

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        waiting: dict = defaultdict(lambda: [[], [], [], 0])

        def block(em):
            nonlocal made
            ids, folds, texts, _ = waiting.pop(em)
            b = numbered(pa.concat_arrays(texts))
            fold, lengths = np.concatenate(folds), np.diff(b.bounds)
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([f"{task}-{made}"]), pa.array([em]), pa.array([len(b.tokens)], pa.int64()), pa.array([int(lengths[fold != HELD_OUT].sum())], pa.int64()),
                pa.array([int(lengths[fold == EM_FOLD].sum())], pa.int64()), pa.array([[i for part in ids for i in part.to_pylist()]], pa.list_(pa.int64())),
                *[pa.array([x], pa.binary()) for x in (packed(fold), packed(lengths.astype("<i4")), packed(b.tokens), packed(b.words, True))],
            ], names=["block", "em", "n", "n_learned", "n_em", "doc_ids", "folds", "lengths", "tokens", "words"])

        for batch in batches:
            ids, texts = batch.columns
            fold = np.array([HELD_OUT if i is None else fold_of(i) for i in ids.to_pylist()], dtype=np.uint8)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 6 + 1
            for em in (False, True):
                rows = np.flatnonzero((fold == EM_FOLD) == em)
                while len(rows):
                    here = waiting[em]
                    n = max(1, int(np.searchsorted(np.cumsum(size[rows]), BLOCK_TOKENS - here[3], side="right")))
                    some, rows = rows[:n], rows[n:]
                    here[0].append(ids.take(pa.array(some)))
                    here[1].append(fold[some])
                    here[2].append(texts.take(pa.array(some)))
                    here[3] += int(size[some].sum())
                    if here[3] >= BLOCK_TOKENS or len(rows):
                        yield block(em)
        for em in list(waiting):
            yield block(em)

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).mapInArrow(run, BLOCKS)


def as_block(row) -> tuple[Block, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum(unpacked(row["lengths"], "<i4"), dtype=np.int64)])
    return Block(unpacked(row["tokens"], "<i4"), bounds, unpacked(row["words"], "<u8", True)), unpacked(row["folds"], "u1")


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    """The group of each key: keys in order stay in order, and groups are ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)


def runs_of(blocks: DataFrame, slots: int) -> DataFrame:
    """Per block, kind (0 words, 1 pairs) and slot: the distinct keys in order, their count in learning texts and in the EM fold."""

    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                block, folds = as_block(row)
                fold = np.repeat(folds, np.diff(block.bounds))
                learns, tries = (fold != HELD_OUT), (fold == EM_FOLD)
                for kind, (keys, index) in enumerate([(block.words, block.tokens), block.pairs()]):
                    count, tried = (np.bincount(index[m], minlength=len(keys)).astype("<u4") for m in (learns, tries))
                    slot, first = np.unique(_slot(keys, slots), return_index=True)
                    cut = [*first, len(keys)]
                    yield pd.DataFrame([(row["block"], kind, s, packed(keys[a:b], True), packed(count[a:b]), packed(tried[a:b])) for s, a, b in zip(slot, cut[:-1], cut[1:], strict=True)],
                                       columns=["block", "kind", "slot", "keys", "counts", "held"])

    return blocks.select("block", "folds", "lengths", "tokens", "words").mapInPandas(run, RUNS)


def totals_of(runs: DataFrame) -> DataFrame:
    """For each run, the totals over all blocks of its keys, in its order; new: how many learned keys no run before it in the group has."""

    def total(pdf):
        keys = [unpacked(k, "<u8", True) for k in pdf["keys"]]
        _, first, index = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])
        sums = [np.bincount(index, np.concatenate([unpacked(c, "<u4") for c in pdf[column]]).astype(np.float64)) for column in ("counts", "held")]
        new = np.bincount(np.searchsorted(ends, first[sums[0] > 0], side="right"), minlength=len(keys))
        parts = [[packed(p) for p in np.split(s.astype("<i8")[index], ends[:-1])] for s in sums]
        return pd.DataFrame({"block": pdf["block"], "kind": pdf["kind"], "slot": pdf["slot"], "counts": parts[0], "held": parts[1], "new": new})

    return runs.groupBy("kind", "slot").applyInPandas(total, TOTALS)


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for none, then 1 + the binary logarithm, up to the last bucket."""
    return np.where(count > 0, np.minimum(1 + np.log2(np.maximum(count, 1)).astype(np.int64), BUCKETS - 1), 0)


def _looked_up(row, totals: pd.DataFrame):
    """(block, folds, per token: c(w), c(h, w), c(h); the same in the EM fold)."""
    block, folds = as_block(row)
    _, pair_index = block.pairs()
    both = []
    for column in ("counts", "held"):
        count = [np.concatenate([np.zeros(0, np.int64), *[unpacked(b, "<i8") for b in totals[totals["kind"] == kind].sort_values("slot")[column]]]) for kind in (0, 1)]
        own = count[0][block.tokens]
        # a text's first word follows an end: as many contexts as ends
        context = np.empty_like(own)
        context[1:] = own[:-1]
        context[block.bounds[:-1]] = own[block.bounds[1:] - 1]
        both.append((own, count[1][pair_index], context))
    return block, folds, *both


def with_totals(blocks: DataFrame, totals: DataFrame, use, schema: str) -> DataFrame:
    """use(row, totals) for each block and the totals of its keys."""

    def run(_, own, totals):
        return pd.concat([use(row, totals) for _, row in own.iterrows()]) if len(own) else pd.DataFrame()

    own = blocks.select("block", "doc_ids", "folds", "lengths", "tokens", "words")
    return own.groupBy("block").cogroup(totals.drop("new").groupBy("block")).applyInPandas(run, schema)


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def learned_weights(blocks: DataFrame, totals: DataFrame, n: int, n_held: int, v: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """weights[bucket] = (pair, word, uniform), by EM on the fold that the counts leave out."""
    base = 1.0 / (v + 1)

    def events(row, own):
        block, folds, every, held = _looked_up(row, own)
        use = np.repeat(folds, np.diff(block.bounds)) == EM_FOLD
        # counts without the fold itself
        w, hw, h = ((a - b)[use] for a, b in zip(every, held, strict=True))
        out = pd.DataFrame({"bucket": _bucket(h), "p2": ratio(hw, h), "p1": w / max(1, n - n_held)})
        return out.groupby(["bucket", "p2", "p1"], as_index=False).size().rename(columns={"size": "times"})

    tries = blocks.filter("em")
    held = written(with_totals(tries, totals.join(tries.select("block"), "block", "left_semi"), events, "bucket int, p2 double, p1 double, times long"), "em")
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    weights[0] = [0, 0.9, 0.1]
    for _ in range(rounds):
        of = lambda i: F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, i]]), F.col("bucket") + 1)  # noqa: B023, E731
        parts = held.select("bucket", "times", (of(0) * F.col("p2")).alias("a"), (of(1) * F.col("p1")).alias("b"), (of(2) * base).alias("c"))
        whole = F.col("times") / (F.col("a") + F.col("b") + F.col("c"))
        got = parts.groupBy("bucket").agg(*[F.sum(F.col(x) * whole).alias(x) for x in "abc"]).collect()
        for r in got:
            share = np.array([r["a"], r["b"], r["c"]])
            if share.sum() > 0:
                # a little stays everywhere, so that no word is impossible
                weights[r["bucket"]] = (share + [0, 1e-6, 1e-6]) / (share.sum() + 2e-6)
    return weights


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = EM_ROUNDS) -> DataFrame:
    """id_column, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    blocks = written(read_blocks(docs, id_column, text_column), "lm-blocks")
    size = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_learned", "n_em")]).collect()[0]
    n, n_held = size["n_learned"], size["n_em"]
    totals = written(totals_of(runs_of(blocks, max(1, -(-size["n"] // GROUP_TOKENS)))), "lm-totals")
    v = totals.filter("kind = 0").agg(F.coalesce(F.sum("new"), F.lit(0)).alias("v")).collect()[0]["v"]
    weights = spark.sparkContext.broadcast(learned_weights(blocks, totals, n, n_held, v, rounds))

    def scored(row, own):
        block, folds, (w, hw, h), _ = _looked_up(row, own)
        a = weights.value[_bucket(h)]
        p = a[:, 0] * ratio(hw, h) + a[:, 1] * (w / max(1, n)) + a[:, 2] / (v + 1)
        known = w > 0
        base = np.log10((w + SMOOTHING) / (n + SMOOTHING * (v + 1)))
        start = block.bounds[:-1]
        return pd.DataFrame({"id": pd.array(list(row["doc_ids"]), dtype="Int64"), "held_out": folds == HELD_OUT, "n_tokens": np.diff(block.bounds), "n_known": np.add.reduceat(known.astype(np.int64), start),
                             "train_tokens": n, "base_score": np.add.reduceat(base, start), "score": np.add.reduceat(np.log10(p), start)})

    return with_totals(blocks, totals, scored, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumnRenamed("id", id_column)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
