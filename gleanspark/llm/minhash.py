"""MinHash near-dedup with fast similarity sketching (operator 12).

A text is the set of its distinct runs of `width` words. Its sketch has one value
per coordinate, filled in rounds: in each of the first rounds, as many as there
are coordinates, a fresh hash throws every element into one coordinate; in as
many rounds after those, round i puts all elements into coordinate i, so every
coordinate of every set that isn't empty is filled. A coordinate keeps the
smallest value of the first round that reached it. Two sets agree in a
coordinate with a probability equal to their Jaccard similarity, concentrated
as if the coordinates were drawn without replacement, and large sets need a
round or two where plain MinHash hashes them once per coordinate.

Sets that agree in all coordinates of a band meet. Copies meet as one. In a few
rounds one member of each band is compared, on the full sets, with all members
that aren't yet connected with it. What is then still apart is compared with each
other: band by band where few share it, and in blocks of bounded size where many
do, by their sketches first and then by halves of the sets' hashes, so that what
leaves a block is linked up to chance. No pair within a component need be
compared, so large groups of near copies cost a few comparisons a member; no
pair that could join two components is left out, whatever the size of a band's
group.

A pair just as alike as asked for is missed with a probability of at most
1 - FOUND. Sets and elements are told apart by 64-bit hashes, up to chance
collisions of about n^2 / 2^65.

Texts without words have an empty set, linked with nothing. Null texts are empty.
Rows without an id are linked like others, but name a component only if no row
in it has an id. Very long texts are read whole, in a slice of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import hashed_words, mixed, quoted, sliced, small, table, tidy, written
from gleanspark.llm.simhash import components
from gleanspark.operators.skew import balanced_join

#: Coordinates in a band.
ROWS = 5
#: Probability that two sets just as alike as asked for meet in some band.
FOUND = 1 - 4e-6
#: A band shared by more sets than this is compared in blocks.
PAIRED = 32
#: Rounds in which one member of each band is compared with all others.
STARS = 2
#: Sets in a block; pairs of a set with one other in a task.
BLOCK, PER_TASK = 1_024, 2_000
ROWS_AT_ONCE = 4_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def bands_for(share: float, rows: int = ROWS, found: float = FOUND) -> int:
    """Bands after which sets with this similarity meet with probability `found`."""
    return ceil(log(1 - found) / log(1 - share ** rows))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, bounds): text i has the set elements[bounds[i]:bounds[i + 1]], hashes in order.

    A text of fewer words than `width` has one element, all its words.
    """
    words, bounds = hashed_words(texts)
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n)), n)
    left = bounds[1:][doc] - np.arange(len(words))
    runs, elements, owners = words, [], []
    for size in range(1, width + 1):
        # runs[i]: the words i to i + size - 1
        use = (left >= size) if size == width else (n[doc] == size) & (left == size)
        use = use[:len(runs)]
        elements.append(mixed(runs[use] + np.uint64(size * _STEP & _MASK)))
        owners.append(doc[:len(runs)][use])
        if size < width:
            runs = mixed(runs[:-1] * np.uint64(_STEP | 1)) + words[size:]
    elements, owners = np.concatenate(elements), np.concatenate(owners)
    order = np.lexsort((elements, owners))
    elements, owners = elements[order], owners[order]
    fresh = np.ones(len(elements), dtype=bool)
    fresh[1:] = (elements[1:] != elements[:-1]) | (owners[1:] != owners[:-1])
    return elements[fresh], np.searchsorted(owners[fresh], np.arange(len(n) + 1))


def sketches(elements: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Per set a row of `size` values; all ones for an empty set."""
    n = np.diff(bounds)
    cells = np.full(len(n) * size, _EMPTY)
    owner = np.repeat(np.arange(len(n)), n)
    for step in range(2 * size):
        x = mixed(elements + np.uint64((step + 1) * _STEP & _MASK))
        bin_ = (x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32) if step < size else np.uint64(step - size)
        # a value of an earlier round is smaller than any of a later one
        np.minimum.at(cells, owner * size + bin_.astype(np.int64), np.uint64(step << 32) | x & np.uint64(0xFFFFFFFF))
        sets = np.unique(owner)
        open_ = np.zeros(len(n), dtype=bool)
        open_[sets] = (cells.reshape(-1, size)[sets] == _EMPTY).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        elements, owner = elements[keep], owner[keep]
    return cells.reshape(-1, size)


def band_keys(values: np.ndarray, bands: int, rows: int, empty: np.ndarray) -> pa.Array:
    """A list of keys, one per band, for each sketch; null where `empty`."""
    keys = np.zeros((len(values), bands), dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys + values[:, i::rows] + np.uint64(_STEP))
    keys = mixed(keys + np.arange(bands, dtype=np.uint64))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel()), mask=pa.array(empty))


def sketch_rows(docs: DataFrame, width: int, bands: int, rows: int, id_column: str, text_column: str) -> DataFrame:
    """id, text_key (tells texts of one id apart), n (size of the set), node (hash of the set) and keys of the bands.
    The last two are null for an empty set."""

    def run(batches):
        for batch in sliced(batches, 2, ROWS_AT_ONCE):
            elements, bounds = shingle_sets(batch.column(2), width)
            n = np.diff(bounds)
            empty = n == 0
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array(n), pa.array(set_hashes(elements, bounds).view(np.int64), mask=empty),
                band_keys(sketches(elements, bounds, bands * rows), bands, rows, empty),
            ], names=["id", "text_key", "n", "node", "keys"])

    rows_ = docs.select(*named(id_column, text_column))
    return rows_.mapInArrow(tidy(run), f"id {dict(rows_.dtypes)['id']}, text_key long, n long, node long, keys array<long>")


def set_hashes(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(elements), dtype=np.uint64)])
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def named(id_column: str, text_column: str) -> list[Column]:
    id_, text = quoted([id_column, text_column])
    return [id_.alias("id"), F.xxhash64(id_.cast("string"), text).alias("text_key"), text.alias("text")]


@dataclass(frozen=True)
class Texts:
    """Where the sets of nodes are taken from once more. `names`: one written row (node, text_key) per node, and others beside it."""

    docs: DataFrame
    names: DataFrame
    width: int
    id_column: str
    text_column: str

    def asking(self, wanted: DataFrame, row_bytes: int) -> DataFrame:
        """The text of each row of the written `wanted` (text_key and others), which are sent to the tasks if they are proven few."""
        wanted = F.broadcast(wanted) if small(wanted, row_bytes) else wanted
        return self.docs.select(*named(self.id_column, self.text_column)[1:]).join(wanted, "text_key").drop("text_key")

    def sets(self, calls: DataFrame) -> DataFrame:
        """(a, part, node, elements) for each of `calls` (a, part, node).

        A set is made once for all its calls (for each PER_TASK of them) and goes at once where the calls say.
        """
        width = self.width
        many = calls.groupBy("node").agg(F.ceil(F.count("*") / PER_TASK).alias("lists"))
        dealt = calls.join(many, "node").join(self.names.select("node", "text_key"), "node")
        lists = dealt.groupBy("text_key", "node", F.expr("pmod(xxhash64(a, part), lists)").alias("list")).agg(F.collect_list(F.struct("a", "part")).alias("calls"))
        # a call is 16 bytes, and each list has one at least
        lists = written(lists.select("text_key", "node", "calls", F.size("calls").alias("n")), "calls")
        row_bytes = 24 + 16 * ceil((lists.agg(F.avg("n")).first()[0] or 0) + 1)

        def run(batches):
            for batch in sliced(batches, 0, ROWS_AT_ONCE):
                elements, bounds = shingle_sets(batch.column(0), width)
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], sets], names=["node", "calls", "elements"])

        found = self.asking(lists.drop("n"), row_bytes).select("text", "node", "calls").mapInArrow(tidy(run), "node long, calls array<struct<a: long, part: int>>, elements array<long>")
        return found.select("node", "elements", F.explode("calls").alias("call")).select("call.*", "node", "elements")

    def halves(self, nodes: DataFrame, bands: int, rows: int) -> DataFrame:
        """(node, keys, marks, short) of `nodes`: the keys of the bands, 16 bits of each coordinate, the upper half of each element."""
        width = self.width

        def run(batches):
            for batch in sliced(batches, 0, ROWS_AT_ONCE):
                elements, bounds = shingle_sets(batch.column(0), width)
                values = sketches(elements, bounds, bands * rows)
                marks = (mixed(values) >> np.uint64(48)).astype("<u2")
                halves = (elements >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    batch.column(1), band_keys(values, bands, rows, np.diff(bounds) == 0), pa.array([m.tobytes() for m in marks], pa.binary()),
                    pa.array([halves[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                ], names=["node", "keys", "marks", "short"])

        wanted = written(self.names.select("node", "text_key").join(nodes, "node", "left_semi"), "wanted")
        found = self.asking(wanted, 24).select("text", "node").mapInArrow(tidy(run), "node long, keys array<long>, marks binary, short binary")
        return written(found.dropDuplicates(["node"]), "halves")


def alike(pairs: DataFrame, texts: Texts, num: int, den: int) -> DataFrame:
    """The (a, b) of the written `pairs` with den * intersection >= num * union. Pairs of a set that has many are dealt over tasks.

    Each set is shuffled once, to the task where it meets the others.
    """
    parts = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("parts")), "parts")
    ones = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"))
    others = pairs.join(parts, "a").select("a", F.expr("cast(pmod(xxhash64(b), parts) as int)").alias("part"), F.col("b").alias("node"))
    # rows that share id and text give their set more than once
    left = texts.sets(ones).select("a", "part", F.col("elements").alias("x")).dropDuplicates(["a", "part"])
    right = texts.sets(others).select("a", "part", F.col("node").alias("b"), F.col("elements").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return right.join(left, ["a", "part"]).filter(den * both >= num * (F.size("x") + F.size("y") - both)).select("a", "b").distinct()


def links(texts: Texts, num: int, den: int, bands: int, rows: int) -> DataFrame:
    """(a, b): links that connect what chains of pairs with den * intersection >= num * union connect.

    The names of `texts` have n and keys beside node and text_key.
    """
    # den * min >= num * max is needed of the sizes
    sizes = lambda x, y: den * F.least(x, y) >= num * F.greatest(x, y)
    keyed = texts.names.select("node", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    told = written(keyed.join(shared, "key").withColumn("label", F.col("node")), "members")
    edges = found = None
    for step in range(STARS):
        # a member of each band that holds several components is compared with those outside its own
        order = F.xxhash64("node", F.lit(step)) if step else F.col("node")
        first = F.min(F.struct(order.alias("order"), "node", "n", "label")).alias("p")
        centre = told.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), first).filter("low != high").select("key", "p.*")
        centre = centre.select("key", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("label").alias("home"))
        rays = told.join(centre, "key").filter((F.col("label") != F.col("home")) & sizes(F.col("n"), F.col("a_n"))).select("a", F.col("node").alias("b"))
        rays = written(rays.distinct(), "stars")
        found = written(alike(rays, texts, num, den), "star-links")
        edges = found if edges is None else edges.union(found)
        if found.isEmpty():
            break
        labels = components(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("least", F.col("node")), edges).select("node", "label")
        told = written(told.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    # bands that hold several components still; every pair left has a member outside the largest label
    open_ = told.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.mode("label", True).alias("home"))
    rest = written(told.join(open_.filter("low != high").select("key", "home"), "key"), "open-bands")
    few = rest.filter(F.col("members") <= PAIRED)
    a, b = few.alias("a"), few.alias("b")
    pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label")) & sizes(F.col("a.n"), F.col("b.n")))
             .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))
    crowd = rest.filter(F.col("members") > PAIRED)
    out = crowd.filter("label != home").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("down"))
    across = F.ceil(F.col("members") / BLOCK).cast("int")
    crowd = written(crowd.join(out, "key").withColumn("across", across), "crowded-bands")
    of = lambda column: F.pmod(F.xxhash64("node"), F.col(column)).cast("int")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    fields = ["key", "i", "j", "node", "n", "label", "marks", "keys", "short"]
    known = texts.halves(crowd.select("node").distinct(), bands, rows)
    left = crowd.filter("label != home").withColumn("i", of("down")).withColumn("j", every("across")).join(known, "node").select(fields)
    right = crowd.withColumn("j", of("across")).withColumn("i", every("down")).join(known, "node").select(*[F.col(c).alias(f"{c}_") for c in fields])
    size = bands * rows
    needed = size * num / den - 6 * sqrt(size * num / den * (1 - num / den))

    def compare(key, x, y):
        y.columns = fields
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        marks, keys_ = np.frombuffer(b"".join(y["marks"]), "<u2").reshape(len(y), -1), np.array(y["keys"].tolist())
        ids, n, label, out = y["node"].to_numpy(), y["n"].to_numpy(), y["label"].to_numpy(), []
        for node, size_, own, mark, bands_, short in zip(x["node"], x["n"], x["label"], x["marks"], x["keys"], x["short"], strict=True):
            fits = np.flatnonzero((label != own) & (den * np.minimum(n, size_) >= num * np.maximum(n, size_)))
            # a pair belongs to the first band that it shares
            same = keys_[fits] == np.array(bands_)
            fits = fits[np.array(bands_)[same.argmax(axis=1)] == key[0]]
            fits = fits[(marks[fits] == np.frombuffer(mark, "<u2")).sum(axis=1) >= needed]
            mine = np.frombuffer(short, "<u4")
            for i in fits.tolist():
                # halves of the hashes: never fewer in common than the sets have
                both = len(np.intersect1d(mine, np.frombuffer(y["short"].iloc[i], "<u4"), assume_unique=True))
                if den * both >= num * (size_ + n[i] - both):
                    out.append((min(node, ids[i]), max(node, ids[i])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    block = ["key", "i", "j"]
    blocks = left.groupBy(block).cogroup(right.groupBy([f"{c}_" for c in block])).applyInPandas(compare, "a long, b long")
    pairs = written(pairs.union(blocks).distinct(), "open-pairs")
    return edges if pairs.isEmpty() else edges.union(alike(pairs, texts, num, den)).distinct()


def near_copies(docs: DataFrame, num: int = 80, den: int = 100, width: int = 2, rows: int = ROWS, id_column: str = "doc_id", text_column: str = "text",
                max_rounds: int = 60) -> DataFrame:
    """id_column, n_shingles, component_id (the smallest id that links lead to, its own included) and kept (it is its own), per row.

    Linked are sets with den * intersection >= num * union.
    """
    bands = bands_for(num / den, rows)
    told = written(sketch_rows(docs, width, bands, rows, id_column, text_column), "sketches")
    full = told.filter("node is not null")
    # copies are one set from here on; any of their texts gives it
    reps = written(full.groupBy("node").agg(F.min("id").alias("least"), F.min("text_key").alias("text_key"), *[F.first(c).alias(c) for c in ("n", "keys")]), "sets")
    nodes = reps.select("node", "least")
    texts = Texts(docs, reps.drop("least"), width, id_column, text_column)
    found = components(nodes, links(texts, num, den, bands, rows), max_rounds)
    names = nodes.join(found.select("node", "smallest", F.lit(True).alias("linked")), "node", "left").select(
        "node", F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("least")).alias("component_id"))
    linked = balanced_join(full.select("id", "n", "node"), written(names, "names"), ["node"], "inner").select("id", "n", "component_id")
    alone = told.filter("node is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id",
                                            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS shingles FROM words
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM members a JOIN members b USING (shingle) WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM pairs WHERE 100 * common >= 80 * (n + m - common)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN ways b ON r.other = b.x
)
SELECT s.doc_id, any_value(len(shingles))::BIGINT AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
FROM sets s JOIN reach USING (doc_id) GROUP BY s.doc_id
"""
