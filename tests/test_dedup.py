from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gleanspark.operators import dedup, items as I, joins as J
from gleanspark.operators.skew import balanced_join, hot_keys
from gleanspark.sources.bucketed import bucketed_scan, bucketed_stats, expire_buckets, merge_into_buckets


def one_by_one(rows):
    urls, names, kept = set(), set(), []
    for rank, u, n in sorted(rows):
        if u not in urls and n not in names:
            urls.add(u)
            names.add(n)
            kept.append(rank)
    return kept


def greedy(spark, rows, **options):
    df = spark.createDataFrame([(r, f"u{u}", f"n{n}") for r, u, n in rows], "rank bigint, url_key string, name_key string")
    return sorted(r["rank"] for r in dedup.greedy_dedup(df, ["rank"], **options).collect())


@pytest.mark.parametrize("rows, kept", [
    ([(1, 1, 1), (2, 2, 1), (3, 2, 3)], [1, 3]),
    ([(1, 1, 1), (2, 1, 2), (3, 2, 2)], [1, 3]),
    ([(1, 1, 1)], [1]),
    ([], []),
])
def test_small_cases(spark, rows, kept):
    assert greedy(spark, rows) == kept


@pytest.mark.parametrize("seed, keys", [(0, 5), (1, 40), (2, 400)])
def test_equals_the_row_by_row_rule(spark, seed, keys):
    rng = random.Random(seed)
    rows = [(rank, rng.randrange(keys), rng.randrange(keys)) for rank in range(600)]
    # rounds only, rounds then chains, chains only, and with hot keys spread
    for options in ({"plain_rounds": 99}, {"plain_rounds": 1}, {"plain_rounds": 0}, {"hot_rows": 3, "plain_rounds": 0}):
        assert greedy(spark, rows, **options) == one_by_one(rows), options


def test_one_key_with_a_third_of_the_rows(spark):
    rng = random.Random(7)
    rows = [(rank, rank, 0 if rank % 3 == 0 else rng.randrange(300)) for rank in range(900)]
    assert greedy(spark, rows, hot_rows=50, plain_rounds=0) == one_by_one(rows)


def test_long_chain_of_conflicts(spark):
    rows = [(i, (i + 1) // 2, i // 2) for i in range(20_000)]
    assert greedy(spark, rows) == one_by_one(rows)


def test_chains_that_meet(spark):
    """Chains in which some rows wait for two, or share a key with many."""
    rng = random.Random(11)
    rows = [(i, (i + 1) // 2, i // 2) for i in range(300)]
    rows += [(300 + k, rng.randrange(150), rng.randrange(150)) for k in range(60)]
    ranks = rng.sample(range(len(rows)), len(rows))
    for mixed in (rows, [(r, u, n) for r, (_, u, n) in zip(ranks, rows, strict=True)]):
        assert greedy(spark, mixed, plain_rounds=0) == one_by_one(mixed)


def test_more_hot_keys_than_are_spread(spark):
    rng = random.Random(12)
    rows = [(rank, rng.randrange(300), rank) for rank in range(3000)]
    assert greedy(spark, rows, hot_rows=5) == one_by_one(rows)


def test_unclean_runs_may_share_their_places(spark):
    """Rows of two earlier runs with one and the same place: each keeps its own keys."""
    schema = "source_rank int, seq bigint, pos bigint, name string, tool_url string"
    fresh = dedup.with_keys(spark.createDataFrame([(0, 0, 0, "new", "http://new")], schema))
    old = dedup.with_keys(spark.createDataFrame([
        (0, 0, 0, "a1", "http://one"), (0, 0, 0, "b1", "http://two"), (0, 0, 0, "c1", "http://new"), (0, 0, 1, "b1", "http://three"), (0, 0, 1, "d1", "http://one/")], schema))
    merged = dedup.cumulative_merge(fresh, old, assume_clean=False)
    assert sorted((r["name"], r["tool_url"]) for r in merged.collect()) == [("a1", "http://one"), ("b1", "http://two"), ("new", "http://new")]


def test_dedup_is_idempotent_and_unique(spark):
    rng = random.Random(3)
    rows = [(rank, rng.randrange(50), rng.randrange(50)) for rank in range(400)]
    df = spark.createDataFrame([(r, f"u{u}", f"n{n}") for r, u, n in rows], "rank bigint, url_key string, name_key string")
    once = dedup.greedy_dedup(df, ["rank"])
    counts = once.agg(F.count("*"), F.countDistinct("url_key"), F.countDistinct("name_key")).first()
    assert len(set(counts)) == 1
    assert sorted(once.collect()) == sorted(dedup.greedy_dedup(once, ["rank"]).collect())


def test_composite_order_and_equal_keys(spark):
    rows = [(1, 0, 0, " - ", "http://x/A/"), (0, 0, 1, "__", "http://y"), (0, 1, 0, "b", "http://x/a"), (2, 0, 0, "c", "https://x/a")]
    df = dedup.with_keys(spark.createDataFrame(rows, "source_rank int, seq bigint, pos bigint, name string, tool_url string"))
    kept = dedup.greedy_dedup(df)
    assert sorted((r["source_rank"], r["seq"]) for r in kept.collect()) == [(0, 0), (0, 1), (2, 0)]


def _keyed(spark, rows):
    return spark.createDataFrame(rows, "pos bigint, url_key string, name_key string, name string").withColumns(
        {"source_rank": F.lit(0), "seq": F.lit(0).cast("bigint")})


@pytest.mark.parametrize("big", [1, 1 << 40, 1 << 62])
def test_ranks_of_several_numbers(spark, big):
    rng = random.Random(big)
    rows = [((rng.randrange(3), rng.randrange(4) * big // 4, i * (1 << 20 if big > 1 else 1)), rng.randrange(30), rng.randrange(30)) for i in range(300)]
    df = spark.createDataFrame([(*r, f"u{u}", f"n{n}") for r, u, n in rows], "source_rank int, seq bigint, pos bigint, url_key string, name_key string")
    kept = sorted((r["source_rank"], r["seq"], r["pos"]) for r in dedup.greedy_dedup(df).collect())
    assert kept == one_by_one(rows)


@pytest.mark.parametrize("small", [True, False])
def test_merge_equals_dedup_of_both(spark, small, monkeypatch):
    monkeypatch.setattr(dedup, "is_small", lambda keys: small)
    monkeypatch.setattr(I, "is_small", lambda keys: small)
    rng = random.Random(11)

    def clean():
        rows = [(i, rng.randrange(60), rng.randrange(60)) for i in range(120)]
        kept = set(one_by_one(rows))
        return [(r, f"u{u}", f"n{n}", f"name{n}") for r, u, n in rows if r in kept]

    fresh, previous = clean(), clean()
    merged = dedup.cumulative_merge(_keyed(spark, fresh), _keyed(spark, previous))
    slow = dedup.cumulative_merge(_keyed(spark, fresh), _keyed(spark, previous), assume_clean=False)
    rows = lambda df: sorted(tuple(r) for r in df.select("url_key", "name_key", "pos").collect())
    assert rows(merged) == rows(slow)
    old_urls = {u for _, u, _, _ in previous}
    assert sorted(r["url_key"] for r in I.never_seen(_keyed(spark, fresh), _keyed(spark, previous)).collect()) == sorted(
        u for _, u, _, _ in fresh if u not in old_urls)
    assert {(u, n) for _, u, n, _ in fresh} <= {r[:2] for r in rows(merged)}


def test_known_name_with_new_url_is_new_and_replaces(spark):
    fresh, previous = _keyed(spark, [(0, "u2", "n1", "fresh")]), _keyed(spark, [(0, "u1", "n1", "old")])
    assert I.never_seen(fresh, previous).count() == 1
    assert [r["name"] for r in dedup.cumulative_merge(fresh, previous).collect()] == ["fresh"]
    stats = I.run_stats(dedup.cumulative_merge(fresh, previous), fresh, previous, "now").first()
    assert tuple(stats) == ("now", 1, 1)


def test_short_name_shadows_before_it_leaves(spark):
    rows = _keyed(spark, [(0, "u1", "ab", " ab "), (1, "u1", "other", "other")])
    merged = dedup.cumulative_merge(dedup.greedy_dedup(rows), _keyed(spark, []))
    assert merged.count() == 1
    assert dedup.finalize_snapshot(merged).count() == 0


def test_first_rows(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "tool_url string, pos bigint")
    assert sorted(tuple(r) for r in dedup.distinct_first(df, order=["pos"]).collect()) == [("a", 1), ("b", 3)]
    links = spark.createDataFrame([(1, "http://X/", 0), (1, "http://x", 1), (2, "http://x", 0)], "article int, href string, pos int")
    assert dedup.distinct_links_per_article(links, ["article"]).count() == 2


def test_caps_and_order(spark):
    df = spark.createDataFrame([("a", 0, p, f"2024-01-0{p + 1}") for p in range(5)] + [("b", 0, 0, "2024-01-03")],
                               "source string, seq int, pos int, date_iso string")
    assert I.cap_per_source(df, 2).count() == 3
    assert I.cap_per_source(df, 4, own_cap=F.when(F.col("source") == "a", 1).otherwise(4)).count() == 2
    newest = I.newest_first(df, ["source", "pos"]).collect()
    assert [r["date_iso"] for r in newest][:3] == ["2024-01-05", "2024-01-04", "2024-01-03"]
    mixed = spark.createDataFrame([(0, "2024-01-01T01:00:00+05:00"), (1, "2024-01-01T00:00:00+00:00")], "pos int, date_iso string")
    assert [r["pos"] for r in I.newest_first(mixed, ["pos"]).collect()] == [0, 1]
    assert [r["pos"] for r in I.newest_first(mixed, ["pos"], chronological=True).collect()] == [1, 0]


def test_balanced_join_gives_the_plain_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 10}") for i in range(300)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    assert len(hot_keys(left, ["k"], 50)) == 1
    for how in ("left", "left_semi", "left_anti", "inner"):
        plain, spread = left.join(right, "k", how), balanced_join(left, right, ["k"], how, 50)
        assert sorted(plain.collect(), key=str) == sorted(spread.select(plain.columns).collect(), key=str), how


def test_first_author_reply(spark):
    items = spark.createDataFrame([("1", "a", ""), ("2", "a", "own"), ("3", "a", ""), (None, "a", "")], "story_id string, author string, description string")
    replies = spark.createDataFrame(
        [("1", 0, "b", "other"), ("1", 1, "a", ""), ("1", 2, "a", "second"), ("1", 3, "a", "third"), ("2", 0, "a", "unused")],
        "story_id string, pos int, author string, text string")
    got = {r["story_id"]: r["description"] for r in J.first_author_reply(items, replies, lambda t: F.upper(t)).collect()}
    assert got == {"1": "SECOND", "2": "own", "3": "", None: ""}


def test_blocklists(spark):
    links = spark.createDataFrame([("https://www.microsoft.com/a",), ("https://ft.com",), ("https://netflix.com",), ("https://a.x.com:443/b",), ("https://ok.org/?u=x.com",)], "href string")
    kept = lambda df: sorted(r["href"] for r in df.collect())
    assert kept(J.blocklist_anti(links)) == ["https://netflix.com", "https://ok.org/?u=x.com", "https://www.microsoft.com/a"]
    assert kept(J.blocklist_anti(links, match="contains")) == []
    table = spark.createDataFrame([("FT.com",), ("x.com",)], "domain string")
    for hot_rows in (0, 1000):
        assert kept(J.blocklist_anti_table(links, table, hot_rows=hot_rows)) == kept(J.blocklist_anti(links))


def test_lookup_takes_the_last_value_that_is_there(spark):
    pairs = spark.createDataFrame([("a", 0, "free", None), ("a", 1, "paid", "d"), ("a", 2, None, None)], "slug string, pos int, tier string, date string")
    facts = J.last_by_slug(pairs, ["tier", "date"])
    tools = spark.createDataFrame([("a",), ("b",)], "slug string")
    rows = J.lookup_by_slug(tools, facts, {"tier": "unknown", "date": ""}).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "paid", "d"), ("b", "unknown", "")]


def test_runs_in_buckets_equal_whole_merges(spark, tmp_path):
    """Runs of any size, repeated ones, and ones that leave buckets empty; the store is what cumulative_merge makes of the same rows."""
    rng, path, whole = random.Random(4), str(tmp_path / "store"), {}
    for run, size in enumerate((60, 8, 0, 1, 40)):
        rows = [(run * 100 + k, f"u{rng.randrange(90)}", f"n{rng.randrange(90)}", rng.choice(["a name", "x"])) for k in range(size)]
        fresh = dedup.greedy_dedup(spark.createDataFrame(rows, "pos bigint, url_key string, name_key string, name string"), ["pos"])
        for _ in range(2 if run == 1 else 1):
            stats = merge_into_buckets(fresh, path, run, "now", buckets=7)
        fresh = {(r["pos"], r["url_key"], r["name_key"], r["name"]) for r in fresh.collect()}
        urls, names = {r[1] for r in fresh}, {r[2] for r in fresh}
        assert stats["new_today"] == len(urls - {r[1] for r in whole.get(run - 1, ())})
        whole[run] = {r for r in whole.get(run - 1, set()) if r[1] not in urls and r[2] not in names} | {r for r in fresh if len(r[3]) >= 3}
        like = spark.createDataFrame([], "pos bigint, url_key string, name_key string, name string")
        assert {tuple(r) for r in bucketed_scan(like, path).collect()} == whole[run] and stats["count"] == len(whole[run])
    assert {tuple(r) for r in bucketed_scan(like, path, before=2).collect()} == whole[1]
    assert [r["count"] for r in bucketed_stats(spark, path).orderBy("run_id").collect()] == [len(whole[r]) for r in range(5)]
    # the run of one row wrote one bucket, or two if it replaced a row elsewhere
    assert len(list((tmp_path / "store" / "items" / "run_id=3").glob("bucket=*"))) <= 3
    assert expire_buckets(spark, path, 1) > 4 and {tuple(r) for r in bucketed_scan(like, path).collect()} == whole[4]
