"""Nearest neighbours: what the stopping test leaves out, several cells, ids that ask with several vectors."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleanspark.llm import ann

SF = "/root/testdata/sf0.1"
K = 20


def clustered(n: int, clusters: int, seed: int = 1) -> np.ndarray:
    r = np.random.default_rng(seed)
    return r.normal(size=(clusters, 64))[r.integers(0, clusters, n)] + r.normal(size=(n, 64)) * 0.7


def given() -> np.ndarray:
    x = np.array(pd.read_parquet(f"{SF}/embeddings.parquet")["embedding"].tolist(), dtype=np.float64)
    return x[np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)]


def recall_of(found: set, x: np.ndarray, queries: np.ndarray) -> float:
    """found: (row that asks, row found)."""
    s = x[queries] @ x.T
    s[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-s, axis=1, kind="stable")[:, :K]
    return len(found & {(int(q), int(i)) for q, own in zip(queries, best, strict=True) for i in own}) / (K * len(queries))


@pytest.mark.parametrize("vectors, every", [
    pytest.param(given, 20, marks=pytest.mark.skipif(not Path(SF).exists(), reason="test data not there")),
    (lambda: clustered(20_000, 400), 100),
], ids=["given", "clustered"])
def test_verified_share_and_recall(monkeypatch, vectors, every):
    x, verified, real = vectors(), [0], ann.scores

    def counted(v, q):
        verified[0] += len(v)
        return real(v, q)

    monkeypatch.setattr(ann, "scores", counted)
    plan = ann.Plan(x, float((x * x).sum(axis=1).max()), len(x), ann.PROJECTED, ann.CONFIDENCE)
    queries = np.arange(0, len(x), every)
    place, ids, _ = ann.search_block(np.arange(len(x)), x, plan.project(x), queries, x[queries], plan.project(x[queries], lifted=False),
                                     np.full(len(queries), -np.inf), K, plan.stop, plan.norm2)
    assert recall_of({(int(queries[p]), int(i)) for p, i in zip(place, ids, strict=True)}, x, queries) >= 0.95
    assert verified[0] < 0.5 * len(queries) * len(x)


def test_several_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 400)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    x = clustered(3_000, 40)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    queries = np.arange(0, len(x), 50)
    assert recall_of({(r["query_id"], r["vec_id"]) for r in rows}, x, queries) >= 0.95
    for q in queries.tolist():
        own = sorted((r["rank"], -r["score"], r["vec_id"]) for r in rows if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, K + 1)) and [o[1:] for o in own] == sorted(o[1:] for o in own)
        assert all(abs(-s - x[q] @ x[i]) < 1e-9 for _, s, i in own)


def test_cells_of_many_queries_are_those_of_each():
    x = clustered(2_000, 30)
    plan = ann.Plan(x, float((x * x).sum(axis=1).max()), 20 * ann.CELL_ROWS, 8, 0.9)
    p = plan.project(x[:50], lifted=False)
    for limit in (0.0, 50.0, 400.0, np.inf):
        row, cell = plan.near(p, np.full(len(p), limit))
        together = set(zip(row.tolist(), cell.tolist(), strict=True))
        assert len(together) == len(row)
        assert together == {(i, int(c)) for i in range(len(p)) for c in plan.near(p[i:i + 1], np.array([limit]))[1]}
        # the own cell is always among them, all of them without a limit
        assert {(i, int(c)) for i, c in enumerate(plan.cell(p))} <= together
    assert len(together) == len(p) * plan.cells and plan.cells == 20


def test_an_id_that_asks_with_two_vectors_gets_two_lists(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0]), (2, [5.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("vec_id") == 0, k=3).collect())
    assert found == sorted([(1, 2, 5.0), (2, 1, 2.0), (3, 2, 1.0), (1, 2, 3.0), (2, 1, 1.0), (3, 2, 0.0)])
