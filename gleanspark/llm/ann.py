"""Nearest neighbours by stable projections and kd-trees (operator 4).

Largest inner product becomes smallest Euclidean distance: vectors get one more
component that gives all the same norm, queries get 0 there. Distances are
estimated in PROJECTED dimensions by a Gaussian (2-stable) projection: for a
vector at distance r, the squared projected distance over r^2 is chi-square with
that many degrees of freedom.

A kd-tree on a bounded sample splits the projected space into cells; every vector
goes to its cell, and cells with many vectors are dealt over several blocks, so
that a vector that is repeated very often fills no task alone. Each block builds
its own kd-tree. A query visits the leaves of a tree in order of projected
distance and verifies exactly the vectors in them that the chi-square test leaves
open: a vector nearer than the k-th found has a smaller projected distance than
the test's limit with probability CONFIDENCE. It stops where leaves begin that lie
beyond the limit.

The search has two rounds. A query first looks into its home cell; the distance
of its k-th there bounds the second round, in which it visits just the cells that
the same test can't rule out.

Vectors that are null, zero, of another length, or hold null or non-finite
components take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import table, written

PROJECTED = 48
CONFIDENCE = 0.9
#: Vectors that the top-level tree is fitted on, vectors it aims at per cell, and most vectors in one block.
SAMPLE_ROWS, CELL_ROWS, BLOCK_ROWS = 20_000, 8_192, 16_384
LEAF_ROWS = 64
#: Queries that meet a block in one task.
QUERY_ROWS = 1_024


def chi_square_quantile(p: float, k: int) -> float:
    """x with P(chi-square of k degrees <= x) = p, by bisection on the incomplete gamma series."""
    from math import exp, lgamma, log

    def cdf(x: float) -> float:
        a, y = k / 2, x / 2
        term = total = 1 / a
        n = 1
        while term > total * 1e-15:
            term *= y / (a + n)
            total += term
            n += 1
        return total * exp(a * log(y) - y - lgamma(a))

    low, high = 1e-9, 10.0 * k + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision; each row's sum is made the same way wherever the row stands, so equal vectors tie."""
    return (vectors * queries).sum(axis=1)


def build(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """kd-tree leaves: (order, starts, lows, highs). Split by rank on the widest side, so equal points spread too."""
    order, starts, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        a, b = todo.pop()
        if b - a <= leaf_rows:
            starts.append(a)
            continue
        own = points[order[a:b]]
        side, mid = int(np.argmax(own.max(0) - own.min(0))), (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own[:, side], mid, kind="introselect")]
        todo += [(a + mid, b), (a, a + mid)]
    starts = np.array(sorted(starts), dtype=np.int64)
    sorted_points = points[order]
    return order, starts, np.minimum.reduceat(sorted_points, starts, axis=0), np.maximum.reduceat(sorted_points, starts, axis=0)


def box_distances(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each row of q from each box."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        x = q[:, d, None]
        gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0)
        out += gap * gap
    return out


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each query, ties to the smaller id, query by query."""
    order = np.lexsort((ids, -score, query))
    own = query[order]
    first = np.searchsorted(own, own)
    return order[np.arange(len(order)) - first < k]


def search_block(ids, vectors, points, q_ids, q_vectors, q_points, bounds, k: int, stop: float, norm2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, vec_id, score) of the best k in a block for each query.

    bounds: inner product known to be reached by k candidates elsewhere, -inf if none.
    All queries go through their leaves in order of projected distance, some more
    leaves each step. Of a leaf, only neighbours whose own projected distance passes
    the test are verified; the k-th found so far tightens it from step to step.
    """
    order, starts, lows, highs = build(points)
    ids, vectors, points = ids[order], vectors[order], points[order]
    length_x, length_p = (points * points).sum(axis=1), (q_points * q_points).sum(axis=1)
    ends = np.append(starts[1:], len(ids))
    to_leaf = box_distances(q_points, lows, highs)
    by_distance = np.argsort(to_leaf, axis=1, kind="stable")
    length2, kth = (q_vectors * q_vectors).sum(axis=1), bounds.copy()
    found = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
    at, step = 0, 2
    while at < len(starts):
        # squared distance of the k-th: norm2 + |q|^2 - 2 (inner product)
        limit = np.where(np.isinf(kth), np.inf, stop * np.maximum(0.0, norm2 + length2 - 2 * np.where(np.isinf(kth), 0, kth)) + 1e-9)
        leaves = by_distance[:, at:at + step]
        query, place = np.nonzero(np.take_along_axis(to_leaf, leaves, axis=1) <= limit[:, None])
        if not len(query):
            break
        leaf = leaves[query, place]
        by_leaf = np.argsort(leaf, kind="stable")
        cut = np.searchsorted(leaf[by_leaf], np.arange(len(starts) + 1))
        new_q, new_row = [], []
        for i in np.flatnonzero(np.diff(cut)):
            asked = query[by_leaf[cut[i]:cut[i + 1]]]
            # a neighbour is verified only if its own projected distance passes the test
            gap = length_p[asked, None] + length_x[starts[i]:ends[i]] - 2 * (q_points[asked] @ points[starts[i]:ends[i]].T)
            a, b = np.nonzero(gap <= limit[asked, None])
            new_q.append(asked[a])
            new_row.append(starts[i] + b)
        new_q, new_row = np.concatenate(new_q), np.concatenate(new_row)
        other = ids[new_row] != q_ids[new_q]
        new_q, new_row = new_q[other], new_row[other]
        exact = np.concatenate([np.zeros(0), *[scores(vectors[new_row[i:i + 100_000]], q_vectors[new_q[i:i + 100_000]]) for i in range(0, len(new_q), 100_000)]])
        # what is below the k-th found can't be among the best
        reach = exact >= kth[new_q]
        found = [np.concatenate(x) for x in zip(found, (new_q[reach], ids[new_row[reach]], exact[reach]), strict=True)]
        keep = best(*found, k)
        found = [x[keep] for x in found]
        full = np.flatnonzero(np.bincount(found[0], minlength=len(q_ids)) == k)
        last = np.searchsorted(found[0], full, side="right") - 1
        kth[full] = np.maximum(kth[full], found[2][last])
        at, step = at + step, step * 2
    return tuple(found)


def usable(vector: Column, dimensions: int) -> Column:
    """The vector has `dimensions` finite components that aren't all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Plan:
    """What all tasks know: projection, cells (boxes of the sample's kd-tree, open at the outside) and the stopping constant."""

    def __init__(self, sample: np.ndarray, norm2: float, rows: int, projected: int, confidence: float, seed: int = 42):
        self.norm2 = norm2
        self.projection = np.random.default_rng(seed).normal(size=(sample.shape[1] + 1, projected))
        self.stop = chi_square_quantile(confidence, projected)
        cells = max(1, -(-rows // CELL_ROWS))
        self.splits: list = []  # (side, value, left, right), or a cell's number
        self.cells = 0
        self._split(self.project(sample), cells)

    @classmethod
    def of(cls, state: dict) -> Plan:
        """A plan from its plain parts: an object of this class could be read only where the package is installed."""
        plan = cls.__new__(cls)
        vars(plan).update(state)
        return plan

    def _split(self, points: np.ndarray, cells: int) -> int:
        node = len(self.splits)
        self.splits.append(None)
        side = int(np.argmax(points.max(0) - points.min(0))) if len(points) else 0
        value = float(np.median(points[:, side])) if len(points) else 0.0
        left = points[:, side] <= value if len(points) else None
        if cells == 1 or len(points) < 2 or left.all():
            self.splits[node] = self.cells
            self.cells += 1
            return node
        self.splits[node] = (side, value, self._split(points[left], cells // 2), self._split(points[~left], cells - cells // 2))
        return node

    def project(self, vectors: np.ndarray, lifted: bool = True) -> np.ndarray:
        """Projections of vectors; lifted ones get the component that completes their norm."""
        extra = np.sqrt(np.maximum(self.norm2 - (vectors * vectors).sum(axis=1), 0)) if lifted else np.zeros(len(vectors))
        return vectors @ self.projection[:-1] + extra[:, None] * self.projection[-1]

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            what = self.splits[node]
            if isinstance(what, int):
                out[rows] = what
                continue
            left = points[rows, what[0]] <= what[1]
            todo += [(what[2], rows[left]), (what[3], rows[~left])]
        return out

    def near(self, p: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of p, cell): cells within the squared projected distance limits[i] of p[i]; all rows go down the tree together."""
        rows, cells, todo = [], [], [(0, np.arange(len(p)), np.zeros(p.shape))]
        while todo:
            node, at, gap = todo.pop()
            what = self.splits[node]
            if isinstance(what, int):
                rows.append(at)
                cells.append(np.full(len(at), what))
                continue
            side, value, left, right = what
            for child, beyond in ((left, p[at, side] > value), (right, p[at, side] <= value)):
                far = gap.copy()
                far[beyond, side] = np.maximum(far[beyond, side], np.abs(p[at[beyond], side] - value))
                within = (far * far).sum(axis=1) <= limits[at]
                if within.any():
                    todo.append((child, at[within], far[within]))
        return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(cells or [np.zeros(0, np.int64)])


def _array(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            projected: int = PROJECTED, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, id_column, score: for each row that `queries` picks, its k nearest of all other rows found.

    Ties go to the smaller id. Rows that share an id are one candidate each and
    never answer a query of that id; if they ask, each of their distinct vectors
    gets ranks of its own, and equal ones ask once. Null ids take no part.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), queries.alias("asks")).filter("id is not null and v is not null")
    sizes = raw.filter("size(v) > 0").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    result = f"query_id long, rank int, {id_column} long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    dimensions = sizes[0]["d"]
    rows = raw.filter(usable(F.col("v"), dimensions))
    about = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm2")).collect()[0]
    if not about["n"]:
        return spark.createDataFrame([], result)
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    plan = spark.sparkContext.broadcast(vars(Plan(_array(sample), float(about["norm2"]), about["n"], projected, confidence)))

    def at_hand() -> Plan:
        return Plan.of(plan.value)

    def place(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = _array(pdf["v"])
            # a query looks from where it stands with 0 in the added component
            yield pd.DataFrame({"id": pdf["id"], "v": [r.tobytes() for r in x], "cell": at_hand().cell(at_hand().project(x)),
                                "asks": pdf["asks"].fillna(False).astype(bool), "home": at_hand().cell(at_hand().project(x, lifted=False))})

    placed = written(rows.mapInPandas(place, "id long, v binary, cell int, asks boolean, home int"), "placed")
    counts = placed.groupBy("cell").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    counts = written(counts, "cells")
    data = placed.join(F.broadcast(counts), "cell").select("cell", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int").alias("block"), "id", "v")
    data = written(data, "blocks")
    # an id with several vectors asks once with each
    asking = placed.filter("asks").select("id", F.xxhash64("v").alias("which"), "v", "home").distinct()

    def visit(key, own, asked):
        if not len(own) or not len(asked):
            return pd.DataFrame({"query_id": [], "which": [], "vec": [], "score": []}).astype({"query_id": "int64", "which": "int64", "vec": "int64"})
        x, q = (np.frombuffer(b"".join(d["v"]), dtype=np.float64).reshape(len(d), -1) for d in (own, asked))
        place, *found = search_block(own["id"].to_numpy(), x, at_hand().project(x), asked["id"].to_numpy(), q, at_hand().project(q, lifted=False),
                             asked["bound"].to_numpy(dtype=np.float64), k, at_hand().stop, at_hand().norm2)
        return pd.DataFrame({"query_id": asked["id"].to_numpy()[place], "which": asked["which"].to_numpy()[place], "vec": found[0], "score": found[1]})

    def searched(asked: DataFrame) -> DataFrame:
        """asked: (id, v, bound, cell). Each query meets all blocks of its cells; many queries of a cell are dealt over tasks."""
        groups = written(asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "asked")
        parts = groups.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
        plan_rows = written(parts.join(counts.select("cell", "blocks"), "cell"), "visits")
        left = (data.join(F.broadcast(plan_rows), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cell", "block", "part", "id", "v"))
        right = (groups.join(F.broadcast(plan_rows), "cell").withColumn("part", (F.col("part") % F.col("parts")).cast("int"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "block", "part", "id", "which", "v", "bound"))
        keys = ["cell", "block", "part"]
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(visit, "query_id long, which long, vec long, score double")

    first = written(searched(asking.select("id", "which", "v", F.lit(float("-inf")).alias("bound"), F.col("home").alias("cell"))), "first-round")
    ranked = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec")
    bound = (first.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "which", F.col("score").alias("bound")))

    def others(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            q = np.frombuffer(b"".join(pdf["v"]), dtype=np.float64).reshape(len(pdf), -1)
            points, p = at_hand().project(q, lifted=False), at_hand()
            left = p.norm2 + (q * q).sum(axis=1) - 2 * pdf["bound"].to_numpy(dtype=np.float64)
            row, cell = p.near(points, np.where(np.isinf(left), np.inf, p.stop * np.maximum(0.0, left) + 1e-9))
            away = cell != pdf["home"].to_numpy()[row]
            yield pdf[["id", "which", "v", "bound"]].iloc[row[away]].assign(cell=cell[away].astype(np.int32))

    more = asking.join(bound, ["id", "which"], "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))).select("id", "which", "v", "bound", "home")
    more = more.mapInPandas(others, "id long, which long, v binary, bound double, cell int")
    every = first.unionByName(searched(more))
    return every.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("vec").alias(id_column), "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
