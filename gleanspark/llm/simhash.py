"""SimHash near-dedup with pivot distance tables (operator 6).

Each distinct fingerprint gets a table of Hamming distances to reference
fingerprints ("pivots"), kept for each third of the bits apart. Fingerprints
that differ in at most two bits agree on all bits of some third, and so in all
of that third's distances: those, packed in one number, are the key on which
pairs meet. The distances over all bits are the sums over the thirds; a pair
whose distances to some pivot differ by more than two is discarded, and what is
left is verified on the bits.

A key that many fingerprints share isn't paired at all: each of its members
links to itself and to the 64 fingerprints one bit away. Two fingerprints differ
in at most two bits exactly if such neighbourhoods meet, so the same components
come out, from 65 rows per member whatever the group's size. Pairs are thus never
more than PAIRED times the fingerprints.

Components come from rounds of smallest labels along links and over the label's
own label. Copies share a fingerprint and never meet as pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import free_name, one_of_each, quoted, table, tidy, written

BITS = 64
#: Bits of the three parts.
PARTS = ((0, 22), (22, 43), (43, 64))
#: Reference fingerprints; the distances to them within a part fill one 64-bit key.
PIVOTS = 12
#: A key shared by more fingerprints than this goes by neighbourhoods.
PAIRED = 32
#: Shingles whose bits are summed at once.
AT_ONCE = 100_000


def pivots() -> list[int]:
    """The reference fingerprints: a fixed pseudo-random sequence (splitmix64)."""
    out, x, mask = [], 0, (1 << 64) - 1
    for _ in range(PIVOTS):
        x = (x + 0x9E3779B97F4A7C15) & mask
        z = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & mask
        out.append(z ^ z >> 31)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mixed(h: np.ndarray, view: int) -> np.ndarray:
    """Another hash of the same shingles; view 0 is the hash itself."""
    if not view:
        return h
    h = (h ^ np.uint64(view * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64, seed 42, of each run of `width` words; of all words if there are fewer; of nothing without words."""
    from xxhash import xxh64_intdigest

    # bytes.split and bytes.lower know just ASCII: the six white space characters and A-Z
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, ends = b" ".join(words), list(accumulate([len(w) + 1 for w in words]))
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, 42)], dtype=np.uint64)
    starts = [0, *ends[:len(words) - width]]
    return np.array([xxh64_intdigest(joined[a:b - 1], 42) for a, b in zip(starts, ends[width - 1:], strict=True)], dtype=np.uint64)


def majority(h: np.ndarray) -> int:
    """Each bit that is set in more than half of `h`, as a signed 64-bit integer; 0 without any."""
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), AT_ONCE):
        total += np.unpackbits(h[at:at + AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, views: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column and fps, `views` fingerprints of the whole text. Null and empty texts: 0."""

    def run(batches):
        for batch in batches:
            hashes = (shingle_hashes(t.as_py(), width) for t in batch.column(1))
            fps = [[majority(_mixed(h, v)) for v in range(views)] for h in hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.list_(pa.int64()))], names=["id", "fps"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(run), f"id {dict(rows.dtypes)['id']}, fps array<long>").withColumnRenamed("id", id_column)


def _distances(fp: Column) -> list[list[Column]]:
    """Distances to each pivot within each part."""
    masks = [(1 << b) - (1 << a) for a, b in PARTS]
    return [[F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))).bitwiseAND(F.lit(_signed(m)))).cast("long") for p in pivots()] for m in masks]


def _packed(distances: list[Column]) -> Column:
    """Twelve distances of at most 22 in one long."""
    return reduce(lambda a, d: F.shiftleft(a, 5).bitwiseOR(d), distances)


def pivot_table(fps: DataFrame) -> DataFrame:
    """fp, keys (one per part), and near: the distance to each pivot over all bits, a byte column per pivot."""
    parts = _distances(F.col("fp"))
    near = [sum(p[i] for p in parts).cast("byte").alias(f"d{i}") for i in range(PIVOTS)]
    return fps.select("fp", *near, F.array(*map(_packed, parts)).alias("keys"))


def links(fps: DataFrame, paired: int = PAIRED) -> DataFrame:
    """(a, b): links that connect just what is within two bits of each other, from distinct `fp` (long)."""
    keyed = written(pivot_table(fps).select("*", F.posexplode("keys").alias("part", "key")).drop("keys"), "pivots")
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("members")).filter("members > 1")
    keyed = written(keyed.join(sizes, ["part", "key"]), "shared-keys")
    few = keyed.filter(F.col("members") <= paired)
    a, b = few.alias("a"), few.alias("b")
    far = F.greatest(*[F.abs(F.col(f"a.d{i}") - F.col(f"b.d{i}")) for i in range(PIVOTS)])
    pairs = (a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
             .filter(far <= 2).filter(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= 2)
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    crowd = keyed.filter(F.col("members") > paired).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
    ball = crowd.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("hub"))
    # hubs that one member has link nothing; the smallest member stands for the others
    hubs = ball.groupBy("hub").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = ball.join(hubs, "hub").filter("fp > least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label, smallest): the smallest `least` in each node's component. nodes: (node, least); edges: (a, b).

    Each round takes the smallest label among neighbours and then that label's own
    label, which halves what is left of a chain. A graph not done after
    `max_rounds` raises; no result is cut short.
    """
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    for _ in range(max_rounds):
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("mid"))
        up = step.select(F.col("node").alias("mid"), F.col("mid").alias("top"))
        labels = written(step.join(up, "mid").select("node", F.least("mid", "top").alias("label"), (F.least("mid", "top") != F.col("was")).alias("moved")), "labels")
        if labels.filter("moved").isEmpty():
            break
        labels = labels.drop("moved")
    else:
        raise RuntimeError(f"components are not done after {max_rounds} rounds: a chain of links is too long; raise max_rounds")
    labels = labels.select("node", "label")
    smallest = labels.join(nodes, "node").groupBy("label").agg(F.min("least").alias("smallest"))
    return labels.join(smallest, "label").select("node", "label", "smallest")


def near_duplicates(prints: DataFrame, max_rounds: int = 60) -> DataFrame:
    """From (doc_id, fp): doc_id, fp, component_id, the smallest doc_id in the row's component. Null ids never name a component
    unless all its ids are null."""
    nodes = written(prints.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least")), "nodes")
    found = components(nodes, links(nodes.select(F.col("node").alias("fp"))), max_rounds)
    named = nodes.join(found.select("node", "smallest", F.lit(True).alias("linked")), "node", "left").select(
        F.col("node").alias("fp"), F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("least")).alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text", max_rounds: int = 60) -> DataFrame:
    """`docs` with one row of each group of texts that fingerprints link: the one with the smallest id, null ids last.

    Texts of one id that differ are told apart by a hash; of rows that share id and
    text one is in the running. Texts without words have fingerprint 0 and are
    linked like any other. Very long texts are read whole, a row at a time.
    """
    member = free_name(docs, "member")
    id_, text = quoted([id_column, text_column])
    name = F.struct(id_.isNull().alias("none"), id_.alias("id"), F.xxhash64(text).alias("text"))
    prints = fingerprints(docs.withColumn(member, name), width, id_column=member, text_column=text_column)
    prints = written(prints.select(F.col(member).alias("doc_id"), F.col("fps")[0].alias("fp")), "fingerprints")
    groups = near_duplicates(prints, max_rounds).groupBy(F.col("doc_id").alias(member)).agg(
        F.first("component_id").alias("stays"), F.count("*").alias("rows"))
    return one_of_each(docs, name, groups.withColumn("stays", F.col(member).eqNullSafe(F.col("stays"))), member)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = written(fingerprints(table(spark, sf_dir, "documents")).select("doc_id", F.col("fps")[0].alias("fp")), "fingerprints")
    return near_duplicates(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
