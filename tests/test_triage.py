from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanspark.operators import items as I, triage as T

ORDER = ["pos"]


@pytest.fixture
def items(spark):
    rows = [(0, "u0", "free"), (1, "u1", "unknown"), (2, "u2", "paid"), (3, "u3", "freemium"), (4, "u4", "free"), (5, "u5", None)]
    return spark.createDataFrame(rows, "pos bigint, tool_url string, pricing string").withColumns({
        "name": F.concat(F.lit("n"), "pos"), "description": F.when(F.col("pos") == 4, "").otherwise("d"), "source": F.lit("s"),
        "categories": F.when(F.col("pos") == 4, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"), F.lit("b")))})


def _states(spark, pairs):
    return spark.createDataFrame([(u, s, 1) for u, s in pairs], "tool_url string, state string, ts bigint")


def test_last_change_wins(spark):
    changes = spark.createDataFrame([("u", "pub", 5, 1), ("u", "done", 5, 2), ("u", "ign", 4, 9), ("v", "pending", 1, 1)],
                                    "tool_url string, state string, ts bigint, seq bigint")
    assert sorted(tuple(r) for r in T.latest_triage_state(changes).collect()) == [("u", "done", 5), ("v", "pending", 1)]
    resets = spark.createDataFrame([(4,), (1,)], "ts bigint")
    assert {r["seq"] for r in T.reset_triage(changes, resets).collect()} == {1, 2}
    assert T.reset_triage(changes, resets.where("false")).count() == 4


def test_states_views_and_counts(spark, items):
    triaged = T.with_triage_state(items, _states(spark, [("u1", "pub"), ("u4", "pub"), ("u2", "done"), ("u3", "ign"), ("gone", "pub")]))
    view = lambda v: sorted(r["pos"] for r in T.triage_view(triaged, v).collect())
    assert (view("all"), view("pending"), view("pub"), view("done"), view("free")) == ([0, 1, 2, 3, 4, 5], [0, 5], [1, 4], [2], [0, 3, 4])
    with pytest.raises(ValueError):
        T.triage_view(triaged, "ign")
    assert tuple(T.triage_counts(triaged, 3).first()) == (6, 2, 1, 2, 3, 3)
    assert sorted(r["name"] for r in T.selection_list(triaged).collect()) == ["n1", "n4"]
    assert T.selection_list(triaged).where("name = 'n1'").first()["categories"] == "a · b"
    assert {tuple(r) for r in I.count_by_pricing(items).collect()} == {("free", 2), ("unknown", 2), ("paid", 1), ("freemium", 1)}
    hot = T.with_triage_state(items, _states(spark, [("u1", "pub")]), hot_rows=0)
    assert {r["pos"]: r["state"] for r in hot.collect()}[1] == "pub"


def test_prune_keeps_exact_urls_only(spark, items):
    kept = T.prune_triage(_states(spark, [("u1", "pub"), ("U1", "pub"), ("u1/", "pub")]), items)
    assert [r["tool_url"] for r in kept.collect()] == ["u1"]


def test_order(spark, items):
    triaged = T.with_triage_state(items, _states(spark, [("u1", "pub")]))
    order = lambda df: [r["pos"] for r in df.collect()]
    assert order(T.triage_order(triaged, ORDER)) == [0, 4, 3, 5, 2, 1]
    assert order(T.triage_order(triaged, ORDER, parity=True)) == [3, 0, 4, 5, 2, 1]
    only_pending = T.with_triage_state(items, _states(spark, []))
    assert order(T.triage_order(only_pending, ORDER)) == [0, 1, 2, 3, 4, 5]


def test_newest_first_by_default(spark, items):
    dated = items.withColumns({
        "date_iso": F.when(F.col("pos") != 2, F.concat(F.lit("2026-04-2"), (F.col("pos") % 3).cast("string"))),
        "source_rank": F.lit(0), "seq": F.lit(0)})
    all_pub = T.with_triage_state(dated, _states(spark, [(f"u{i}", "pub") for i in range(6)]))
    blocks = T.export_block(all_pub).collect()
    # dates end in 0 1 - 0 1 2 by pos; the one without comes last
    assert [r["pos"] for r in blocks] == [5, 1, 4, 0, 3, 2]
    assert [r["block"].startswith("n") for r in blocks] == [True] + [False] * 5
    assert T.export_block(all_pub.where("false")).count() == 0
    assert [r["pos"] for r in T.triage_order(all_pub).collect()] == [5, 1, 4, 0, 3, 2]
    lone = T.export_block(all_pub.where("pos = 2")).collect()
    assert len(lone) == 1 and lone[0]["block"].startswith("n2")


def test_export_files_are_the_block(spark, items, tmp_path):
    triaged = T.with_triage_state(items, _states(spark, [("u1", "pub"), ("u4", "pub")])).repartition(4)
    blocks = T.export_block(triaged, ORDER).collect()
    first = "n1\nu1\n\nd\n\nCatégories : a, b\nSource : s\nPricing : unknown"
    second = "n4\nu4\n\n(sans description)\n\nCatégories : —\nSource : s\nPricing : free"
    whole = f"{first}\n\n────────\n\n{second}"
    assert "".join(r["block"] for r in blocks) == whole
    T.write_export(triaged, str(tmp_path / "out"), ORDER)
    parts = sorted(Path(tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text("utf-8") for p in parts) == whole + "\n"


def test_state_stream_equals_batch(spark, tmp_path):
    from gleanspark.streaming.increment import triage_state_stream

    changes = spark.createDataFrame([(f"u{i % 7}", "pub" if i % 2 else "done", i // 3, i) for i in range(60)],
                                    "tool_url string, state string, ts bigint, seq bigint")
    changes.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = triage_state_stream(stream).writeStream.format("memory").queryName("states").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(spark.table("states").collect()) == sorted(T.latest_triage_state(changes).collect())


def test_resets_in_a_stream_equal_batch(spark, tmp_path):
    from gleanspark.streaming import increment as N

    changes = spark.createDataFrame([(f"u{i % 7}" if i % 11 else None, "pub" if i % 2 else "done", (i * 37) % 60, i, None if i % 3 else False) for i in range(60)], N.TRIAGE_EVENT_SCHEMA)
    resets = spark.createDataFrame([(None, None, 20, 100, True), (None, None, 55, 101, True), (None, None, 3, 102, True)], N.TRIAGE_EVENT_SCHEMA)
    into, kept = str(tmp_path / "in"), str(tmp_path / "kept")

    def expected(upto):
        return sorted(T.latest_triage_state(T.reset_triage(changes.where("seq % 100 < 60"), resets.where(f"seq < {upto}").select("ts"))).collect(), key=repr)

    def run(checkpoint="checkpoint"):
        stream = spark.readStream.schema(N.TRIAGE_EVENT_SCHEMA).option("maxFilesPerTrigger", 2).parquet(into)
        query = N.keep_triage(stream, kept, str(tmp_path / checkpoint))
        query.awaitTermination(120)
        return sorted(N.read_triage(spark, kept).collect(), key=repr)

    assert N.fold_triage(spark, kept) is None and N.read_triage(spark, kept).count() == 0
    changes.unionByName(resets.where("seq = 100")).repartition(5).write.parquet(into)
    assert run() == expected(101)
    # every batch once more, as after a lost checkpoint
    assert run("again") == expected(101)
    assert N.fold_triage(spark, kept) == N.fold_triage(spark, kept) == 2
    assert sorted(N.read_triage(spark, kept).collect(), key=repr) == expected(101)
    # an early change that comes late, a later reset and an older one
    resets.where("seq > 100").coalesce(1).write.mode("append").parquet(into)
    assert run() == expected(200)
    late = spark.createDataFrame([("u1", "ign", 19, 200, False), ("u2", "ign", 99, 201, False)], N.TRIAGE_EVENT_SCHEMA)
    late.coalesce(1).write.mode("append").parquet(into)
    N.fold_triage(spark, kept)
    found = {r["tool_url"]: r["state"] for r in run()}
    assert found == {**{r["tool_url"]: r["state"] for r in expected(200)}, "u2": "ign"}
