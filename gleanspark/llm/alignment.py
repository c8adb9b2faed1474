"""Alignment of two tokenizers' tokens (operator 11).

Each text is tokenised whole by both: byte-level BPE of the tokenizers library
(A) and a sentencepiece model (B). The tokens' bytes are laid along the text.
Where both have a token that ends, and both go on with a token that starts with a
space, stands an anchor: it cuts a document into windows of a few token ids of
each side. What a window's ids say about its groups and links doesn't depend on
where it stands, so each distinct pair of id tuples is aligned once and
remembered.

How many documents link a pair of ids is counted in blocks: a block, some
megabytes of text, sends each of its distinct pairs once, with the number of its
documents that link it, and gets the totals back, so a pair found everywhere is
shuffled once per block and not once per document.

A text is left without tokens, with zeros and an empty digest, if it is null or
empty, or if either side's bytes differ from a space and the text. Rows without an
id and repeated rows are documents like others. A very long text makes a block of
its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.bpe import Encoder, pieces_of, public_pattern
from gleanspark.llm.common import mixed, sliced, table, tidy, written

#: Bytes of text and rows in a block.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 20_000
#: Windows that a task remembers before it starts anew.
REMEMBERED = 100_000
_MARK = "▁"


class Pieces:
    """A sentencepiece model whose pieces never hold a space mark after another character."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_MARK in n.lstrip(_MARK) for n in names):
            raise ValueError("pieces that go on past a space can't be told apart word by word")
        self.token_bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(_MARK, " ").encode() for i, n in enumerate(names)]
        self.token_length = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.flat = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)
        self.space = self.model.piece_to_id(_MARK)

    def distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths, fine): piece i, which starts with a space, has ids[starts[i]:starts[i] + lengths[i]];
        fine[i]: their bytes are the piece's. The model adds the first space itself."""
        found = self.model.encode([p[1:] for p in pieces], num_threads=1)
        if " " in pieces:
            # of nothing the model makes nothing, not even the space
            found[pieces.index(" ")] = [self.space]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        whole = [p.encode() for p in pieces]
        size = np.fromiter(map(len, whole), np.int64, len(whole))
        there, starts = np.concatenate([[0], np.cumsum(self.token_length[ids])]), np.cumsum(lengths) - lengths
        fine = there[starts + lengths] - there[starts] == size
        flat = gathered(self.flat, self.token_start[ids], self.token_length[ids]).tobytes()
        if not fine.all() or flat != b"".join(whole):
            at = there[starts].tolist()
            fine &= np.array([flat[i:i + n] == w for i, n, w in zip(at, size.tolist(), whole, strict=True)], dtype=bool)
        return ids, starts, lengths, fine


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[0]:starts[0] + lengths[0]], flat[starts[1]:...], one after the other."""
    done = np.cumsum(lengths)
    return flat[np.repeat(starts - done + lengths, lengths) + np.arange(done[-1] if len(done) else 0)]


def named(tokens: int, mark: str) -> np.ndarray:
    """Each id as text, with a mark after it."""
    return np.array([f"{i}{mark}" for i in range(tokens)], dtype=object)


class Aligner:
    """Both tokenizers and the windows aligned so far, inside a task."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        self.a, self.b = Encoder(path_a, pattern, plain=True), Pieces(path_b)
        self.length = self.a.token_length, self.b.token_length
        self.spaced = tuple(np.array([t.startswith(b" ") for t in side.token_bytes]) for side in (self.a, self.b))
        self.known: dict = {}
        self.with_mark = {mark: named(max(map(len, self.length)), mark) for mark in ",|;"}

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids_a, bounds_a, ids_b, bounds_b) of a space and each text; none where the text is null or empty, or bytes differ."""
        use = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        # a space before each text
        empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        index, bounds, pieces = pieces_of(pc.binary_join_element_wise(empty, pc.fill_null(texts, "").cast(pa.large_string()), space))
        flat_a, start_a, length_a = self.a.distinct(pieces)
        flat_b, start_b, length_b, fine = self.b.distinct(pieces)
        size = np.array([len(p.encode()) for p in pieces], dtype=np.int64)
        bytes_a = np.concatenate([[0], np.cumsum(self.length[0][flat_a])])
        fine &= bytes_a[start_a + length_a] - bytes_a[start_a] == size
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        whole = use.to_numpy(zero_copy_only=False).astype(bool)
        whole[doc[~fine[index]]] = False
        kept = whole[doc]
        index, doc = index[kept], doc[kept]
        out = []
        for flat, start, length in ((flat_a, start_a, length_a), (flat_b, start_b, length_b)):
            n = np.bincount(doc, length[index], minlength=len(texts)).astype(np.int64)
            out += [gathered(flat, start[index], length[index]), np.concatenate([[0], np.cumsum(n)])]
        return tuple(out)

    def windows(self, ids_a: np.ndarray, bounds_a: np.ndarray, ids_b: np.ndarray, bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows start in ids_a and ids_b, with the ends of both: at shared ends before tokens that start with a space."""
        ends_a, ends_b = np.cumsum(self.length[0][ids_a]), np.cumsum(self.length[1][ids_b])
        place = np.searchsorted(ends_b, ends_a)
        at_a = np.flatnonzero(ends_b[place] == ends_a) if len(ends_a) else np.zeros(0, dtype=np.int64)
        at_a, at_b = at_a + 1, place[at_a] + 1
        inside = at_a < len(ids_a)
        anchor = ~inside
        anchor[inside] = self.spaced[0][ids_a[at_a[inside]]] & self.spaced[1][ids_b[at_b[inside]]]
        # a document's end is a shared end, and the next one starts with a space
        anchor |= np.isin(at_a, bounds_a)
        return np.concatenate([[0], at_a[anchor]]).astype(np.int64), np.concatenate([[0], at_b[anchor]]).astype(np.int64)

    def aligned(self, ids_a: np.ndarray, sizes_a: np.ndarray, ids_b: np.ndarray, sizes_b: np.ndarray) -> list[tuple[str, int, bytes]]:
        """(groups as text, their number, links as 64-bit a << 32 | b) of each window; window i has the next sizes_a[i] and sizes_b[i] ids.

        All windows lie end to end, and both sides of a window have the same bytes, so
        every end of a token, shared or not, ends the overlap of one pair of tokens,
        and shared ends end groups.
        """
        ends_a, ends_b = np.cumsum(self.length[0][ids_a]), np.cumsum(self.length[1][ids_b])
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = (ids_a[at_a].astype(np.int64) << 32 | ids_b[at_b]).tobytes()
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        last_a, last_b = shared[group_a] == ends_a, shared[group_b] == ends_b
        # group by group, first the ids of a, then those of b
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        mark = self.with_mark
        names = np.concatenate([np.where(last_a, mark["|"][ids_a], mark[","][ids_a]), np.where(last_b, mark[";"][ids_b], mark[","][ids_b])])[order].tolist()
        window = np.repeat(np.arange(len(sizes_a)), sizes_a)
        bounds = lambda n: np.concatenate([[0], np.cumsum(n)]).tolist()
        n_groups = np.bincount(window[last_a], minlength=len(sizes_a)).tolist()
        to_name, to_link = bounds(sizes_a + sizes_b), bounds(8 * np.bincount(window[at_a], minlength=len(sizes_a)))
        return [("".join(names[to_name[i]:to_name[i + 1]]), n_groups[i], links[to_link[i]:to_link[i + 1]]) for i in range(len(sizes_a))]

    def remembered(self, ids_a: np.ndarray, from_a: np.ndarray, ids_b: np.ndarray, from_b: np.ndarray, some: np.ndarray) -> list[tuple[str, int, bytes]]:
        """aligned() of the windows `some`; those met before are looked up by their ids, a mark between the two sides."""
        size_a, size_b = np.diff(from_a)[some], np.diff(from_b)[some]
        own_a, own_b = gathered(ids_a, from_a[some], size_a), gathered(ids_b, from_b[some], size_b)
        ends = np.cumsum(size_a + size_b + 1)
        place = ends - size_b - 1
        ids = np.full(int(ends[-1]) if len(ends) else 0, 0xFFFFFFFF, dtype=np.uint32)
        # a's ids, the mark, b's ids
        ids[np.arange(len(own_a)) + np.repeat(ends - size_a - size_b - 1 - (np.cumsum(size_a) - size_a), size_a)] = own_a
        ids[np.arange(len(own_b)) + np.repeat(place + 1 - (np.cumsum(size_b) - size_b), size_b)] = own_b
        data, cut = ids.tobytes(), [0, *(4 * ends).tolist()]
        keys = [data[i:j] for i, j in zip(cut, cut[1:])]
        found = [self.known.get(k) for k in keys]
        new = np.array([i for i, f in enumerate(found) if f is None], dtype=np.int64)
        if len(new):
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
            fresh = np.zeros(len(some), dtype=bool)
            fresh[new] = True
            results = self.aligned(own_a[np.repeat(fresh, size_a)], size_a[new], own_b[np.repeat(fresh, size_b)], size_b[new])
            for i, result in zip(new.tolist(), results, strict=True):
                found[i] = self.known[keys[i]] = result
        return found

    def block(self, texts: pa.Array) -> Block:
        ids_a, bounds_a, ids_b, bounds_b = self.tokens(texts)
        from_a, from_b = self.windows(ids_a, bounds_a, ids_b, bounds_b)
        doc = np.searchsorted(bounds_a, from_a[:-1], side="right") - 1
        # equal windows of the block are looked up once: a hash of ids and their places tells them
        place_a = np.arange(len(ids_a)) - np.repeat(from_a[:-1], np.diff(from_a))
        place_b = np.arange(len(ids_b)) - np.repeat(from_b[:-1], np.diff(from_b))
        code = lambda ids, place, side: mixed(ids.astype(np.uint64) | place.astype(np.uint64) << np.uint64(20) | np.uint64(side << 62))
        if len(doc):
            hashes = mixed(np.add.reduceat(code(ids_a, place_a, 1), from_a[:-1])) + np.add.reduceat(code(ids_b, place_b, 2), from_b[:-1])
        else:
            hashes = np.zeros(0, dtype=np.uint64)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        found = self.remembered(ids_a, from_a, ids_b, from_b, first)
        names = np.array([f[0] for f in found], dtype=object)
        n_groups, n_links = np.array([f[1] for f in found], dtype=np.int64), np.array([len(f[2]) // 8 for f in found], dtype=np.int64)
        pairs, pair_of = np.unique(np.frombuffer(b"".join([f[2] for f in found]), np.int64), return_inverse=True)
        # of each document: its distinct pairs and how many links each has
        cells = np.repeat(doc, n_links[which]) * max(1, len(pairs)) + gathered(pair_of, (np.cumsum(n_links) - n_links)[which], n_links[which])
        cells, times = np.unique(cells, return_counts=True)
        docs_of = np.bincount(cells % max(1, len(pairs)), minlength=len(pairs))
        starts = np.searchsorted(doc, np.arange(len(texts) + 1))
        own = which.ravel()
        sha = ["" if a == b else hashlib.sha256("".join(names[own[a:b]])[:-1].encode()).hexdigest() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        per_doc = lambda x: np.bincount(doc, x[which], minlength=len(texts)).astype(np.int64)
        return Block(np.diff(bounds_a), np.diff(bounds_b), per_doc(n_groups), per_doc(n_links), sha, pairs, docs_of,
                     np.searchsorted(cells, np.arange(len(texts) + 1) * max(1, len(pairs))), (cells % max(1, len(pairs))).astype("<i4"), times.astype("<i4"))


@dataclass
class Block:
    """Per document: tokens, groups, links and the groups' digest; pairs[i] is a << 32 | b, linked in docs_of[i] documents;
    document d links pairs[which[i]] times[i] times for i in bounds[d]:bounds[d + 1]."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    pairs: np.ndarray
    docs_of: np.ndarray
    bounds: np.ndarray
    which: np.ndarray
    times: np.ndarray


_PER_DOC = ["n_a", "n_b", "n_groups", "n_links"]
_OUT = "id {0}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def read_blocks(docs: DataFrame, path_a: str, path_b: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """One row per block: ids, the documents' numbers as lists, pairs with the number of documents, and links as bytes."""

    def run(batches):
        aligner, task = Aligner(path_a, path_b, pattern), TaskContext.get().partitionId()
        for made, batch in enumerate(sliced(batches, 1, BLOCK_ROWS, BLOCK_BYTES)):
            b = aligner.block(batch.column(1))
            listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x))
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{task}-{made}"]), listed(batch.column(0)), *[listed(getattr(b, c)) for c in _PER_DOC], listed(pa.array(b.sha, pa.string())),
                listed((b.pairs >> 32).astype(np.int32)), listed((b.pairs & 0xFFFFFFFF).astype(np.int32)), listed(b.docs_of),
                *[pa.array([x.tobytes()], pa.binary()) for x in (b.bounds.astype("<i8"), b.which, b.times)],
            ], names=["block", "ids", *_PER_DOC, "sha", "a", "b", "docs", "bounds", "which", "times"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = dict(rows.dtypes)["id"]
    return rows.mapInArrow(tidy(run), f"block string, ids array<{id_type}>, {', '.join(f'{c} array<long>' for c in _PER_DOC)}, sha array<string>, "
                                      "a array<int>, b array<int>, docs array<long>, bounds binary, which binary, times binary")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): how many documents link each pair, and whether no pair of its a is linked in more."""
    pairs = blocks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.docs").alias("n"))
    pairs = written(pairs, "pairs")
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))
    return pairs.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column, n_a, n_b, n_groups, n_links, n_best (links whose pair is among its A id's most frequent), count_sum (over links) and groups_sha256."""
    blocks = written(read_blocks(docs, path_a, path_b, pattern or public_pattern(), id_column, text_column), "blocks")
    id_type = dict(blocks.dtypes)["ids"][6:-1]
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p")).select("block", "place", "p.a", "p.b")
    told = asked.join(pair_counts(blocks), ["a", "b"]).select(F.col("block").alias("of"), "place", "n", "best")

    def finish(own: pa.Table, totals: pa.Table) -> pa.Table:
        place = totals.column("place").to_numpy()
        n, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=bool)
        n[place], best[place] = totals.column("n").to_numpy(), totals.column("best").to_numpy()
        row = own.slice(0, 1).combine_chunks()
        bounds, which, times = (np.frombuffer(row.column(c)[0].as_py(), t) for c, t in (("bounds", "<i8"), ("which", "<i4"), ("times", "<i4")))
        summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
        lists = {c: row.column(c).chunk(0).flatten() for c in ["ids", *_PER_DOC, "sha"]}
        return pa.table([lists["ids"], *[lists[c] for c in _PER_DOC], pa.array(summed(times * best[which])), pa.array(summed(times * n[which])), lists["sha"]],
                        names=["id", *_PER_DOC, "n_best", "count_sum", "groups_sha256"])

    own = blocks.select("block", "ids", *_PER_DOC, "sha", "bounds", "which", "times")
    return own.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(finish, _OUT.format(id_type)).withColumnRenamed("id", id_column)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
