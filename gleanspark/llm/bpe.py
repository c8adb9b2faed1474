"""Byte-level BPE: whole texts to token ids and back (operator 8).

Encoding is exact, equal to the tokenizers library on the whole text:

* A text is cut only where its encoding cannot notice: before a single space
  between two characters that aren't white space. The pieces between such cuts
  repeat a lot, so each distinct piece of a batch is encoded once.
* A long stretch without such a place is cut between pre-tokens; a single long
  pre-token is the "long unsplit text" of tree concatenation. It is cut into
  leaves that are encoded apart, and neighbours are joined in a balanced tree:
  a window of tokens around the join is encoded again, twice as wide each time,
  until its first and last token agree with what the two sides hold. Every pair
  of neighbours in the result then is a pair that BPE itself left side by side,
  and that makes the whole sequence the encoding of the whole text.
* A document longer than `segment_chars` becomes several rows, encoded by any
  tasks, and is joined by document afterwards.

Null texts count as empty; an empty text has no tokens.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import sliced, table, tidy

#: Characters in a row of its own in the plan; a longer document is dealt over rows.
SEGMENT_CHARS = 32_768
#: Bytes in a leaf of the tree: a longer pre-token is encoded by tree concatenation.
LEAF_BYTES = 1_024
#: Pieces whose ids are put together at once, which bounds the memory of a step.
PIECES_AT_ONCE = 200_000
#: Rows of a batch whose pieces are told apart at once.
ROWS_AT_ONCE = 3_000
#: Distinct pieces that are encoded as one text.
JOINED_PIECES = 500

# Unicode white space and the separators U+001C-U+001F, which Python counts too
_SPACE = "\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
# a space beside other white space, and the mark that the fast path uses itself
_ODD = f"[{_SPACE}] | [{_SPACE}]|\\x00"
_CUT = re.compile(r"(?<=\S)(?= \S)")
# two more places, which make pieces repeat more often: between a letter and a stop or comma, and around one line
# break between a stop or comma and a letter; letters up to U+00FF, on which all Unicode versions agree
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MORE_CUTS = ((f"([{_LETTER}])([.,])", "\\1\x00\\2"), (f"([.,])\n([{_LETTER}])", "\\1\x00\n\x00\\2"))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """One tokenizer file, ready to use inside a task. With `plain`, strings of special tokens in a text are plain text."""

    def __init__(self, path: str, pattern: str, plain: bool = False):
        import regex
        from tokenizers import Tokenizer

        # Spark has a task for each core already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        self.pattern = regex.compile(pattern)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special and not plain else None
        self.to_char = byte_alphabet()
        self.model = self.tokenizer.model
        to_byte = {c: b for b, c in enumerate(self.to_char)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token_bytes = [b""] * size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.token_bytes[i] = token.encode() if token in self.special else bytes(to_byte[c] for c in token)
        self.token_length = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_flat = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)

    # long unsplit texts

    def raw(self, data: bytes) -> list[int]:
        """BPE over bytes that belong to one pre-token."""
        return [t.id for t in self.model.tokenize("".join([self.to_char[b] for b in data]))]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours inside one pre-token, from the encodings of each."""
        if not left or not right:
            return left + right
        width = 4
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            window = self.raw(b"".join([self.token_bytes[i] for i in left[-a:] + right[:b]]))
            agrees_left = a == len(left) or window[0] == left[-a]
            agrees_right = b == len(right) or window[-1] == right[b - 1]
            if agrees_left and agrees_right and (len(window) > 1 or a == len(left) and b == len(right)):
                return left[:-a] + window + right[b:]
            width *= 2

    def tree(self, parts: list[list[int]]) -> list[int]:
        """Join neighbours two by two until one sequence is left."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def segments(self, text: str, chars: int) -> list[tuple[str, int]]:
        """Cut `text` into (piece, run): pieces of run 0 encode apart; those of one run above 0 are leaves of one pre-token."""
        out: list[tuple[str, int]] = []
        held, size, run = [], 0, 0

        def flush():
            nonlocal size
            if held:
                out.append(("".join(held), 0))
            held.clear()
            size = 0

        for part in self.special_cut.split(text) if self.special_cut else [text]:
            if part in self.special:
                flush()
                out.append((part, 0))
                continue
            for piece in _CUT.split(part):
                if size + len(piece) > chars:
                    flush()
                if len(piece) <= chars:
                    held.append(piece)
                    size += len(piece)
                    continue
                for token in self.pattern.findall(piece):
                    # not after white space, where the pattern looks at what follows
                    if size + len(token) > chars and (not held or not held[-1][-1].isspace()):
                        flush()
                    if len(token) > chars and not token.isspace() and not held:
                        run += 1
                        out += [(token[i:i + chars], run) for i in range(0, len(token), chars)]
                    elif len(token) > chars and not held and token.isspace():
                        run += 1
                        out += [(token[i:i + chars], run) for i in range(0, len(token), chars)]
                    else:
                        held.append(token)
                        size += len(token)
            # a special token follows, or the end of the text
            flush()
        return out

    def encode_segment(self, piece: str, run: int) -> list[int]:
        if not run:
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        data = piece.encode()
        return self.tree([self.raw(data[i:i + LEAF_BYTES]) for i in range(0, len(data), LEAF_BYTES)])

    def joined(self, parts: list[tuple[list[int], int]]) -> list[int]:
        """The ids of a text from those of its segments, in order."""
        ids, i = [], 0
        while i < len(parts):
            j = i + 1
            while parts[i][1] and j < len(parts) and parts[j][1] == parts[i][1]:
                j += 1
            ids += self.tree([p for p, _ in parts[i:j]])
            i = j
        return ids

    def encode_long(self, text: str) -> list[int]:
        """Tree concatenation inside one task."""
        return self.joined([(self.encode_segment(p, run), run) for p, run in self.segments(text, LEAF_BYTES)])

    # batches

    def distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): piece i has ids[starts[i]:starts[i] + lengths[i]].

        Pieces that may stand beside any other are encoded as one text by the
        hundred; the ids of each are told by how many bytes they stand for.
        """
        starts, lengths = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        free, lone = [], []
        for i, p in enumerate(pieces):
            (free if len(p) > 1 and p[0] == " " and len(p) <= LEAF_BYTES and not p[1].isspace() and not p[-1].isspace() else lone).append(i)
        parts, at = [], 0
        for first in range(0, len(free), JOINED_PIECES):
            some = free[first:first + JOINED_PIECES]
            own = [pieces[i] for i in some]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(own)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = np.searchsorted(np.cumsum(self.token_length[ids]), np.cumsum([len(p.encode()) for p in own])) + 1
            lengths[some] = np.diff(ends, prepend=0)
            starts[some] = at + ends - lengths[some]
            parts.append(ids)
            at += len(ids)
        short = [i for i in lone if len(pieces[i]) <= LEAF_BYTES]
        found = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[i] for i in short], add_special_tokens=False)]
        long = [i for i in lone if len(pieces[i]) > LEAF_BYTES]
        for i, ids in chain(zip(short, found, strict=True), ((i, self.encode_long(pieces[i])) for i in long)):
            parts.append(np.array(ids, dtype=np.uint32))
            starts[i], lengths[i] = at, len(ids)
            at += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32), starts, lengths

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) for runs of `texts` in order; document i of a run has ids[offsets[i]:offsets[i + 1]]."""
        index, bounds, pieces = pieces_of(pc.fill_null(texts, "").cast(pa.large_string()), _MORE_CUTS)
        flat, start, length = self.distinct(pieces)
        doc = 0
        while doc < len(texts):
            end = max(doc + 1, int(np.searchsorted(bounds, bounds[doc] + PIECES_AT_ONCE, side="right")) - 1)
            own = index[bounds[doc]:bounds[end]]
            n = length[own]
            done = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(start[own] - done[:-1], n) + np.arange(done[-1])]
            yield ids, done[bounds[doc:end + 1] - bounds[doc]]
            doc = end

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode(ids, skip_special_tokens=False)."""
        n = self.token_length[ids]
        done = np.cumsum(n)
        data = self.token_flat[np.repeat(self.token_start[ids] - done + n, n) + np.arange(done[-1] if len(done) else 0)]
        return data.tobytes().decode("utf-8", "replace")


def pieces_of(texts: pa.Array, more_cuts: tuple = ()) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(index, bounds, pieces): text i is the pieces index[bounds[i]:bounds[i + 1]], cut before single spaces between two
    characters that aren't white space, and at `more_cuts`. pieces are distinct."""
    if pc.any(pc.match_substring_regex(texts, _ODD)).as_py():
        # the same pieces, cut by Python's pattern
        lists = pa.array([_CUT.split(t) for t in texts.to_pylist()], pa.large_list(pa.large_string()))
    else:
        marked = pc.replace_substring(texts, " ", "\x00 ")
        for pattern, cut in more_cuts:
            marked = pc.replace_substring_regex(marked, pattern, cut)
        lists = pc.split_pattern(marked, "\x00").cast(pa.large_list(pa.large_string()))
        del marked
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    coded = lists.flatten().dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), bounds, coded.dictionary.to_pylist()


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _digest(encoder: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), _sha(ids.astype("<u4").tobytes()), _sha(encoder.decode(ids).encode())


def encode_texts(docs: DataFrame, path: str, pattern: str, finish, fields: str, id_column: str = "doc_id",
                 text_column: str = "text", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """`id_column` and what finish(encoder, ids) gives for each row's whole text; `fields` is the schema of that, as DDL.

    Rows of up to `segment_chars` characters are encoded where they are read.
    Longer ones are cut, dealt over tasks by segment, and joined by row. Repeated
    rows and null ids each keep their row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    out_schema = f"id {dict(docs.select(F.col(id_column).alias('id')).dtypes)['id']}, {fields}"
    names = spark.createDataFrame([], fields).schema.names
    arrow = [pa.int64() if t in ("bigint", "long") else pa.int32() if t == "int" else pa.list_(pa.int32()) if t == "array<int>" else pa.string()
             for _, t in spark.createDataFrame([], fields).dtypes]

    def frame(ids, results):
        columns = list(zip(*results, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, arrow, strict=True))], names=["id", *names])

    def whole(batches):
        encoder = Encoder(path, pattern)
        for batch in sliced(batches, 1, ROWS_AT_ONCE):
            at = 0
            for ids, bounds in encoder.encode(batch.column(1)):
                n = len(bounds) - 1
                yield frame(batch.column(0).slice(at, n), [finish(encoder, ids[bounds[i]:bounds[i + 1]]) for i in range(n)])
                at += n

    def cut(batches):
        encoder = Encoder(path, pattern)
        for batch in batches:
            for i, key, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                parts = encoder.segments(text, segment_chars)
                yield pa.RecordBatch.from_arrays([
                    pa.array([i] * len(parts), batch.schema.field(0).type), pa.array([key] * len(parts), pa.string()),
                    pa.array(range(len(parts)), pa.int32()), pa.array([r for _, r in parts], pa.int32()), pa.array([p for p, _ in parts], pa.string()),
                ], names=["id", "key", "no", "run", "text"])

    def encode(batches):
        encoder = Encoder(path, pattern)
        for batch in batches:
            runs = batch.column(3).to_pylist()
            ids = [np.array(encoder.encode_segment(t, r), "<u4").tobytes() for t, r in zip(batch.column(4).to_pylist(), runs, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary())], names=["id", "key", "no", "run", "ids"])

    # one encoder for all groups of a task
    ready: list = []

    def together(pdf):
        encoder = ready[0] if ready else Encoder(path, pattern)
        ready[:] = [encoder]
        copies = int((pdf["no"] == 0).sum())
        one = pdf.drop_duplicates("no").sort_values("no")
        ids = encoder.joined([(np.frombuffer(b, "<u4").tolist(), int(r)) for b, r in zip(one["ids"], one["run"], strict=True)])
        result = finish(encoder, np.array(ids, dtype=np.uint32))
        return pd.DataFrame([[pdf["id"].iloc[0], *result]] * copies, columns=["id", *names])

    id_type = out_schema.split(", ")[0]
    short = rows.filter(F.length("text") <= segment_chars).mapInArrow(tidy(whole), out_schema)
    pieces = (rows.filter(F.length("text") > segment_chars).select("id", F.sha2("text", 256).alias("key"), "text")
              .mapInArrow(tidy(cut), f"{id_type}, key string, no int, run int, text string")
              .repartition("key", "no").mapInArrow(tidy(encode), f"{id_type}, key string, no int, run int, ids binary"))
    return short.unionByName(pieces.groupBy("id", "key").applyInPandas(together, out_schema)).withColumnRenamed("id", id_column)


def encode_digest(docs: DataFrame, path: str, pattern: str | None = None, **kw) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit integers) and decoded_sha256 of the text decoded from the ids."""
    return encode_texts(docs, path, pattern or public_pattern(), _digest, "n_tokens long, ids_sha256 string, decoded_sha256 string", **kw)


def encode_ids(docs: DataFrame, path: str, pattern: str | None = None, **kw) -> DataFrame:
    """Per row: doc_id and ids, its token ids."""
    return encode_texts(docs, path, pattern or public_pattern(), lambda _, ids: (ids.astype(np.int32),), "ids array<int>", **kw)


def decode_ids(ids: Column, path: str, pattern: str | None = None) -> Column:
    """The text of an array<int> of token ids; null stays null."""
    pattern = pattern or public_pattern()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path, pattern)
        for s in batches:
            yield s.map(lambda v: None if v is None else encoder.decode(np.asarray(v, dtype=np.int64)))

    return text(ids)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
