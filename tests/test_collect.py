from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gleanspark import config
from gleanspark.config import default_sources
from gleanspark.plans.collect import collect
from gleanspark.plans.nightly import run_once
from gleanspark.schema import LANDING_SCHEMA
from gleanspark.sources import payloads as S
from gleanspark.sources.combine import source_fallback
from gleanspark.sources.partners import kept, with_partners
from gleanspark.sources.snapshot import expire_runs, export_json, is_whole, latest_run, read_files, read_runs, snapshot_scan
from gleanspark.streaming.increment import collect_increment, read_landing

AS_OF = datetime(2026, 4, 29, 18, tzinfo=timezone.utc)
NEW, OLD = "Mon, 27 Apr 2026 10:00:00 +0000", "Wed, 01 Apr 2026 10:00:00 +0000"


def rss(*entries):
    items = "".join(f"<item><title>{t}</title><link>{u}</link><description><![CDATA[{d}]]></description><pubDate>{p}</pubDate></item>" for t, u, d, p in entries)
    return f'<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title><link>http://feed</link>{items}</channel></rss>'


def post(title, link, content="", excerpt="", date="2026-04-27T10:00:00+00:00"):
    rendered = lambda s: {"rendered": s}
    return {"title": rendered(title), "link": link, "content": rendered(content), "excerpt": rendered(excerpt), "date": date}


def hit(title, url, story="", author="me", id="1", at=1777300000):
    return {"title": title, "url": url, "created_at_i": at, "story_text": story, "objectID": id, "author": author}


SCRIPT = (r'<script>self.__next_f.push([1,"{\"slug\":\"a\",\"name\":\"Tool \\\"A\\\"\",\"description_short\":\"does a\",\"website_url\":\"https:\\/\\/a.io\"}"])</script>'
          r'<script>self.__next_f.push([1,"{\"slug\":\"b\",\"name\":\"Tool B\",\"description_short\":\"free b\",\"website_url\":\"https://b.io\",\"pricing_tier\":\"paid\",\"published_at\":\"2026-04-27T10:00:00.000Z\"}'
          r'{\"slug\":\"c\",\"name\":\"Old C\",\"description_short\":\"\",\"website_url\":\"https://c.io\",\"published_at\":\"2026-04-01T10:00:00.000Z\"}"])</script>')
LISTING = ('<div class="home-today-row" data-release-ts="1777300000" data-href="https://t.io/x"><span class="home-today-name-text">Row One</span>'
           '<i class="tools-name-tagline">tag</i></div><div class="home-today-row" data-release-ts="1777300000" data-href="u"><span class="home-today-name-text">ab</span></div>'
           '<div class="home-today-row" data-href="u"><span class="home-today-name-text">No date</span></div>')
ARTICLE = ('<div class="gh-content"><p>👀 What\'s happening: <a href="https://m.io/">MatrAIx</a> is out</p><p><a href="https://m.io">again</a></p>'
           '<p><a href="https://arxiv.org/1">a paper</a> <a href="https://netflix.com">contains x.com</a></p></div>')

LANDED = [
    ("Product Hunt", "feed", None, "ok", rss(
        ("AI Mailer", "https://www.producthunt.com/p/1", '<p>Writes mail</p><a href="https://www.producthunt.com/r">Discussion</a> | <a href="https://mailer.io?ref=x">Link</a>', NEW),
        ("Top 10 AI Tools", "https://x", "", NEW), ("Old AI", "https://x", "", OLD), ("Gardening", "https://x", "plants", NEW))),
    ("Hacker News", "hits", None, "ok", json.dumps({"hits": [
        hit("Show HN: An AI thing", "https://thing.io", id="7"), hit("Show HN: An AI thing", "https://thing.io", id="8"),
        hit("Show HN: Agent – x", "https://agent.io", "<p>own &amp; text</p>", id="9"), hit("AI news", "https://x.io/blog/y"), hit("Chess", "https://chess.io"), hit("Show HN: old AI", "https://old.io", at=1)]})),
    ("Hacker News", "replies", "7", "ok", json.dumps({"children": [{"author": "you", "text": "no"}, {"author": "me", "text": None}, {"author": "me", "text": "<i>first</i> reply"}]})),
    ("Aixploria", "posts", None, "ok", json.dumps([
        post("<b>Post</b> One", "https://www.aixploria.com/one", '<a href="https://github.com/x">c</a><a href="https://one.io">go</a>', "<p>about one</p>"),
        post("Post Two", "https://www.aixploria.com/two", "<p>body text</p>", " "), post("Post Three", "", "none"), post("Old Post", "https://o.io", date="2026-04-01T10:00:00+00:00"),
        post("No zone", "https://z.io", date="2026-04-01T10:00:00")])),
    ("Aixploria", "feed", None, "ok", rss(("Unused", "https://unused.io", "", NEW))),
    ("aiapp.fr", "posts", None, "failed", None),
    ("aiapp.fr", "feed", None, "ok", rss(("Fallback", "https://fallback.io", "d", NEW))),
    ("iaweb.fr", "posts", None, "ok", "[]"),
    ("iaweb.fr", "feed", None, "ok", rss(("Not wanted", "https://notwanted.io", "d", NEW))),
    ("FutureTools", "embedded", None, "ok", f"<html><script>var a</script>{SCRIPT}</html>"),
    ("There's an AI", "listing", None, "ok", LISTING),
    ("AI Secret", "feed", None, "ok", rss(("Issue", "https://aisecret.us/1", "", NEW))),
    ("AI Secret", "page", "https://aisecret.us/1", "ok", ARTICLE),
    ("Ben's Bites", "feed", None, "ok", rss(("Ocean", "https://sea.io", "", NEW), ("LLM note", "https://llm.io", "", NEW))),
    ("The Rundown AI", "feed", None, "ok", rss(("Anything", "https://any.io", "", NEW), ("", "https://x", "", NEW))),
    ("TechCrunch AI", "feed", None, "ok", rss(("Acme news", "https://acme.io", "Acme unveils", NEW), ("Quiet", "https://q.io", "", NEW))),
    ("Lobsters", "feed", None, "ok", rss(("I built a thing", "https://built.io", "dropped text", NEW), ("Quiet", "https://q.io", "launch", NEW))),
    ("Best of AI", "sitemap", None, "ok", '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://bestofai.com/t/my-tool</loc><lastmod>2026-04-28</lastmod></url>'
     "<url><loc>https://bestofai.com/t/old</loc><lastmod>2026-01-28</lastmod></url><url><loc>https://bestofai.com/t/nodate</loc></url></urlset>"),
    ("Best of AI", "page", "https://bestofai.com/t/my-tool", "ok", '<meta property="og:description" content="fine">'),
]


@pytest.fixture(scope="module")
def landing(spark):
    rows = [(source, kind, 0, url, status, payload) for source, kind, url, status, payload in LANDED]
    return spark.createDataFrame(rows, LANDING_SCHEMA)


@pytest.fixture(scope="module")
def found(landing):
    return {(r["source"], r["name"]): r for r in collect(landing, AS_OF).collect()}


def test_registry():
    specs = default_sources()
    assert len(specs) == 25 and [s.rank for s in specs] == list(range(25)) and len({s.name for s in specs}) == 25


def test_which_items_each_source_gives(found):
    names = {}
    for source, name in found:
        names.setdefault(source, set()).add(name)
    assert names == {
        "Product Hunt": {"AI Mailer"}, "Hacker News": {"An AI thing", "Agent – x"}, "Aixploria": {"Post One", "Post Two", "No zone"},
        "aiapp.fr": {"Fallback"}, "FutureTools": {'Tool "A"', "Tool B"}, "There's an AI": {"Row One"}, "AI Secret": {"MatrAIx"},
        "Ben's Bites": {"LLM note"}, "The Rundown AI": {"Anything"}, "TechCrunch AI": {"Acme news"}, "Lobsters": {"I built a thing"},
        "Best of AI": {"My Tool"},
    }


def test_fields(found):
    get = lambda source, name: tuple(found[source, name][f] for f in ("tool_url", "description", "date_iso", "pricing"))
    now, day = AS_OF.isoformat(), "2026-04-27T10:00:00+00:00"
    assert get("Product Hunt", "AI Mailer") == ("https://mailer.io?ref=x", "Writes mail", day, "unknown")
    assert get("Hacker News", "An AI thing")[1] == "first reply"
    assert get("Hacker News", "Agent – x")[:3] == ("https://agent.io", "own & text", "2026-04-27T14:26:40+00:00")
    assert get("Aixploria", "Post One") == ("https://one.io", "about one", day, "unknown")
    assert get("Aixploria", "Post Two") == ("https://www.aixploria.com/two", "body text", day, "unknown")
    assert get("Aixploria", "No zone")[2] == now
    assert get("FutureTools", 'Tool "A"') == ("https://a.io", "does a", now, "unknown")
    assert get("FutureTools", "Tool B") == ("https://b.io", "free b", "2026-04-27T10:00:00.000Z", "paid")
    assert get("There's an AI", "Row One")[:2] == ("https://t.io/x", "tag")
    assert get("AI Secret", "MatrAIx")[:2] == ("https://m.io/", "MatrAIx is out")
    assert get("Lobsters", "I built a thing")[1] == ""
    assert get("Best of AI", "My Tool") == ("https://bestofai.com/t/my-tool", "fine", "2026-04-28T00:00:00", "unknown")


def test_lenient_collection_reads_more_dates_and_whole_hosts(landing):
    rows = {(r["source"], r["name"]) for r in collect(landing, AS_OF, parity=False).collect()}
    assert ("Aixploria", "No zone") not in rows
    assert ("AI Secret", "contains x.com") in rows and ("AI Secret", "a paper") not in rows


def test_unknown_kind(landing):
    from gleanspark.config import SourceSpec

    with pytest.raises(ValueError):
        collect(landing, AS_OF, [SourceSpec("x", 0, "gopher", 1)])


def test_feed_forms(spark):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title type="html">A &amp;amp; B</title><link rel="self" href="http://self"/>'
            '<link href="http://a"/><content type="html">&lt;p&gt;c&lt;/p&gt;</content><updated>2026-04-27T10:00:00Z</updated></entry></feed>')
    one = '<rss><channel><item><title> T </title><link> http://t </link></item></channel></rss>'
    rdf = ('<rdf:RDF xmlns:rdf="x" xmlns:dc="y"><channel><title>c</title></channel><item><title>R</title><link>http://r</link><dc:date>2026-04-27</dc:date></item></rdf:RDF>')
    payloads = spark.createDataFrame([("atom", 0, atom), ("rss", 0, one), ("rdf", 0, rdf), ("bad", 0, "not xml"), ("none", 0, None)], "source string, seq bigint, payload string")
    rows = {r["source"]: tuple(r)[2:] for r in S.feed_scan(payloads).collect()}
    assert rows == {
        "atom": (0, "A &amp; B", "http://a", "<p>c</p>", "2026-04-27T10:00:00Z"), "rss": (0, "T", "http://t", "", None),
        "rdf": (0, "R", "http://r", "", "2026-04-27")}


def test_feed_cap_counts_entries_before_filters(spark):
    payload = rss(*[(f"t{i}", f"http://{i}", "", NEW) for i in range(9)])
    payloads = spark.createDataFrame([("a", 0, payload), ("b", 0, payload)], "source string, seq bigint, payload string")
    capped = S.feed_scan(payloads, F.when(F.col("source") == "a", 2).otherwise(5))
    assert sorted((r["source"], r["count"]) for r in capped.groupBy("source").count().collect()) == [("a", 2), ("b", 5)]


def test_fallback_only_after_failure(spark):
    schema = "source string, v int"
    primary = spark.createDataFrame([("a", 1)], schema)
    secondary = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2)], schema)
    failed = spark.createDataFrame([("c",)], "source string")
    for hot_rows in (0, 100):
        rows = source_fallback(primary, secondary, failed, ["source"], hot_rows)
        assert sorted(tuple(r) for r in rows.collect()) == [("a", 1), ("c", 2)]


def _rows(spark, path):
    return sorted(tuple(r) for r in snapshot_scan(spark, path).select("name", "tool_url", "date_iso").collect())


def test_runs_accumulate_and_can_be_repeated(spark, landing, tmp_path):
    path = str(tmp_path / "snap")
    assert snapshot_scan(spark, path).count() == 0 and latest_run(spark, path) is None
    run_once(landing, path, 0, AS_OF)
    first = _rows(spark, path)
    assert [tuple(r) for r in read_runs(spark, path).select("run_id", "count", "new_today").collect()] == [(0, len(first), len(first))]
    later = spark.createDataFrame([
        ("The Rundown AI", "feed", 1, None, "ok", rss(("Anything", "https://moved.io", "", NEW), ("Fresh one", "https://fresh.io", "", NEW)))], LANDING_SCHEMA)
    for _ in range(2):
        run_once(later, path, 1, AS_OF)
        second = _rows(spark, path)
        assert len(second) == len(first) + 1
        assert ("Anything", "https://moved.io", "2026-04-27T10:00:00+00:00") in second
        assert tuple(read_runs(spark, path).where("run_id = 1").select("count", "new_today").first()) == (len(second), 2)
    export_json(snapshot_scan(spark, path), str(tmp_path / "json"))
    text = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "json").glob("part-*")))
    dates = [json.loads(line)["date_iso"] for line in text.splitlines()]
    assert dates == sorted(dates, reverse=True)
    assert "Agent – x" in text and len(text.splitlines()) == len(second)


def test_older_snapshot_rows_get_defaults(spark, tmp_path):
    from gleanspark.schema import as_items

    old = spark.createDataFrame([("n", "u", 3)], "name string, tool_url string, pos bigint")
    row = as_items(old).first()
    assert (row["pricing"], row["date_iso"], row["categories"], row["pos"]) == ("unknown", "", [], 3)


def test_stream_of_landings_equals_batch_runs(spark, landing, tmp_path):
    third = spark.createDataFrame([("TLDR AI", "feed", 2, None, "ok", rss(("An extra", "https://extra.io", "", NEW)))], LANDING_SCHEMA)
    folder = tmp_path / "landing"
    landing.coalesce(1).write.parquet(str(folder))
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    run_once(landing, batch, 0, AS_OF)
    run_once(third, batch, 1, AS_OF)
    for step in range(2):
        query = collect_increment(read_landing(spark, str(folder)), stream, str(tmp_path / "checkpoint"), lambda _: AS_OF)
        query.awaitTermination(300)
        assert query.exception() is None
        if step == 0:
            third.coalesce(1).write.mode("append").parquet(str(folder))
    assert _rows(spark, stream) == _rows(spark, batch)
    assert latest_run(spark, stream) == 1


def test_answers_are_cut_by_their_source_only(spark):
    posts = [{"title": {"rendered": f"Item number {i}"}, "link": f"https://dir.example/{i}", "date": "2026-04-22T10:00:00",
              "content": {"rendered": f'<a href="https://item{i}.example/">x</a> a text that is long enough'}, "excerpt": {"rendered": ""}} for i in range(60)]
    hits = {"hits": [{"title": f"t{i}", "url": "u", "objectID": str(i)} for i in range(60)]}
    landing = spark.createDataFrame([("dir", "posts", 0, "", "ok", json.dumps(posts)), ("h", "hits", 0, "", "ok", json.dumps(hits))], LANDING_SCHEMA)
    assert S.wp_posts_scan(landing.where("kind = 'posts'")).count() == 60
    assert S.search_hits_scan(landing.where("kind = 'hits'")).count() == 60
    for cap in (3, 45):
        assert collect(landing.where("kind = 'posts'"), AS_OF, [config.SourceSpec("dir", 0, "posts", cap)]).count() == cap


def test_partners_meet_whichever_batch_they_land_in(spark, tmp_path):
    page = '<head><meta property="og:title" content="Late Page"><meta property="og:description" content="text"></head>'
    sitemap = "<urlset><url><loc>https://s.io/tool/a</loc><lastmod>2026-04-28T10:00:00Z</lastmod></url></urlset>"
    rows = {
        "feed": [("n", "feed", 0, None, "ok", rss(("Issue", "https://n.io/1", "", NEW)))],
        "article": [("n", "page", 0, "https://n.io/1", "ok", ARTICLE)],
        "sitemap": [("s", "sitemap", 0, None, "ok", sitemap)],
        "page": [("s", "page", 0, "https://s.io/tool/a", "ok", page)],
        "hits": [("h", "hits", 0, None, "ok", json.dumps({"hits": [hit("Show HN: An AI thing", "https://thing.io", id="7")]}))],
        "replies": [("h", "replies", 1, "7", "ok", json.dumps({"children": [{"author": "me", "text": "It does things"}]}))],
        "fallback": [("p", "feed", 0, None, "ok", rss(("Fallen Back", "https://p.io/x", "text", NEW)))],
        "failed": [("p", "posts", 0, None, "failed", None)],
    }
    specs = [config.SourceSpec("n", 0, "newsletter", 5), config.SourceSpec("s", 1, "sitemap", 5), config.SourceSpec("h", 2, "hits", 5),
             config.SourceSpec("p", 3, "posts", 5, fallback_cap=5)]
    everything = spark.createDataFrame([r for part in rows.values() for r in part], LANDING_SCHEMA)
    run_once(everything, str(tmp_path / "whole"), 0, AS_OF, specs)
    items = lambda path: sorted(map(tuple, snapshot_scan(spark, path).select("name", "tool_url", "description").collect()))
    want = items(str(tmp_path / "whole"))
    assert {"Late Page", "An AI thing", "Fallen Back", "MatrAIx"} <= {r[0] for r in want} and "It does things" in {r[2] for r in want}
    for name, order in (("forth", list(rows)), ("back", list(rows)[::-1])):
        landing, snapshot = str(tmp_path / f"{name}-in"), str(tmp_path / f"{name}-out")
        for part in (order[::2], order[1::2]):
            spark.createDataFrame([r for k in part for r in rows[k]], LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
            query = collect_increment(read_landing(spark, landing), snapshot, str(tmp_path / f"{name}-check"), lambda _: AS_OF, specs)
            query.awaitTermination(300)
            assert query.exception() is None
        assert items(snapshot) == want


def feed_of(spark, *payloads):
    df = spark.createDataFrame([(f"s{i}", 0, p) for i, p in enumerate(payloads)], "source string, seq bigint, payload string")
    return [[tuple(r)[2:] for r in sorted(S.feed_scan(df).where(F.col("source") == f"s{i}").collect(), key=lambda r: r["pos"])] for i in range(len(payloads))]


def test_feeds_that_are_not_well_formed(spark):
    item = lambda t, u, d="": f"<item><title>{t}</title><link>{u}</link><description>{d}</description></item>"
    good = item("Good", "http://g")
    wrap = lambda *items: "<rss><channel>" + "".join(items) + "</channel></rss>"
    blank, ampersand, unknown, cut, wrong, control, page, nothing = feed_of(
        spark, '\n <?xml version="1.0"?>' + wrap(good), wrap(item("R&D", "http://a?x=1&y=2"), good), wrap(item("caf&eacute;&nbsp;&amp;eacute; &#65;", "http://e", "a < b"), good),
        wrap(good, item("Cut", "http://c"))[:-40], wrap(item("<b>Wrong", "http://w"), good), wrap(item("a\x0cb", "http://k", "<![CDATA[<p>x & y</p> ]] > &eacute;]]> &amp; z"), good), "<html><body>no</body></html>", "")
    good = ("Good", "http://g", "", None)
    assert blank == [(0, *good)]
    assert ampersand == [(0, "R&D", "http://a?x=1&y=2", "", None), (1, *good)]
    assert unknown == [(0, "café\xa0&eacute; A", "http://e", "a < b", None), (1, *good)]
    assert cut == [(0, *good)] and wrong == [(1, *good)]
    assert control == [(0, "ab", "http://k", "<p>x & y</p> ]] > &eacute; & z", None), (1, *good)]
    assert page == [] and nothing == []
    # an entry that isn't closed takes none with it
    assert feed_of(spark, "<rss><item><title>Open" + wrap(item("a", "http://a")))[0] == [(1, "a", "http://a", "", None)]


def test_feed_entries_fall_back_to_other_elements(spark):
    body = "".join([
        '<item><title>a</title><guid>http://guid</guid><content:encoded>&lt;p&gt;body&lt;/p&gt;</content:encoded><dc:date>2026-04-27</dc:date></item>',
        '<item><title>b</title><guid isPermaLink="false">http://no</guid><description>d</description><updated>2026-04-26</updated></item>',
        '<item><title>c</title><link>http://link</link><guid isPermaLink="true">http://guid</guid><pubDate>2026-04-25</pubDate><dc:date>x</dc:date></item>'])
    for payload in (f"<rss><channel>{body}</channel></rss>", f"<rss><channel>{body}<item><title>cut"):
        assert feed_of(spark, payload)[0] == [(0, "a", "http://guid", "<p>body</p>", "2026-04-27"), (1, "b", None, "d", "2026-04-26"), (2, "c", "http://link", "", "2026-04-25")]


def test_outcomes_of_reading(spark):
    entry = "<url><loc>http://l</loc><lastmod>2026-04-28</lastmod></url>"
    rows = {
        ("feed", "ok", rss(("t", "http://t", "", NEW))): ("ok", 1), ("feed", "ok", "<rss><channel></channel></rss>"): ("empty", None),
        ("feed", "ok", rss(("t & t", "http://t", "", NEW))): ("mended", 1), ("feed", "ok", "<html>no</html>"): ("unreadable", None), ("feed", "failed", None): ("failed", None),
        ("sitemap", "ok", f"<urlset>{entry}</urlset>"): ("ok", 1), ("sitemap", "ok", f"<urlset>{entry}{entry}<url>"): ("mended", 2), ("sitemap", "ok", "nothing"): ("unreadable", None),
        ("posts", "ok", "[]"): ("empty", 0), ("posts", "ok", "{}"): ("empty", 0), ("posts", "ok", '[{"link": "x"}]'): ("ok", 1), ("posts", "ok", '{"code": 1}'): ("unreadable", None),
        ("posts", "ok", "[1, 2]"): ("unreadable", None), ("posts", "ok", "[null]"): ("unreadable", None), ("posts", "ok", '[{"link": '): ("unreadable", None), ("posts", "ok", "<p>"): ("unreadable", None),
        ("hits", "ok", '{"hits": []}'): ("empty", 0), ("hits", "ok", '{"error": 1}'): ("unreadable", None), ("page", "ok", "anything"): ("ok", None), ("page", "ok", None): ("failed", None),
    }
    landing = spark.createDataFrame([("s", kind, i, None, status, payload) for i, (kind, status, payload) in enumerate(rows)], LANDING_SCHEMA)
    told = {r["seq"]: (r["outcome"], r["entries"] or None) for r in S.payload_outcomes(landing).collect()}
    assert [told[i] for i in range(len(rows))] == [(o, n or None) for o, n in rows.values()]


def test_a_late_page_brings_nothing_old_back(spark, tmp_path):
    """Batch 0: an issue and its first page; batch 1: a feed that lists its item elsewhere; batch 2: a second page alone."""
    page = lambda name, url: f'<div class="gh-content"><p>A tool: <a href="{url}">{name}</a> is here</p></div>'
    issues = rss(("Issue 1", "https://n.io/1", "", NEW), ("Issue 2", "https://n.io/2", "", NEW))
    batches = [
        [("n", "feed", 0, None, "ok", issues), ("n", "page", 0, "https://n.io/1", "ok", page("Alpha", "https://u1.io"))],
        [("f", "feed", 0, None, "ok", rss(("Alpha", "https://u9.io", "", NEW)))],
        [("n", "page", 0, "https://n.io/2", "ok", page("Gamma", "https://u3.io"))],
    ]
    specs = [config.SourceSpec("n", 0, "newsletter", 5), config.SourceSpec("f", 1, "feed", 5)]
    landing, snapshot = str(tmp_path / "in"), str(tmp_path / "out")
    for part in batches:
        spark.createDataFrame(part, LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        query = collect_increment(read_landing(spark, landing), snapshot, str(tmp_path / "check"), lambda _: AS_OF, specs)
        query.awaitTermination(300)
        assert query.exception() is None
    assert {(r["name"], r["tool_url"]) for r in snapshot_scan(spark, snapshot).collect()} == {("Alpha", "https://u9.io"), ("Gamma", "https://u3.io")}
    # the second page met its issue, and nothing else of what had landed
    store = f"{snapshot}-landed"
    new = spark.createDataFrame(batches[2], LANDING_SCHEMA)
    assert sorted((r["kind"], r["batch"]) for r in with_partners(new, store, 2).collect()) == [("feed", 0), ("page", 2)]
    assert {(r["kind"], r["batch"]) for r in kept(new, store, 9).collect()} == {("feed", 0), ("page", 0), ("feed", 1), ("page", 2)}


def test_damaged_runs_are_passed_over_and_old_ones_expire(spark, tmp_path):
    path, specs = str(tmp_path / "snap"), [config.SourceSpec("TLDR AI", 0, "feed", 20)]
    for run in range(4):
        more = spark.createDataFrame([("TLDR AI", "feed", run, None, "ok", rss((f"Item {run}", f"https://i{run}.io", "", NEW)))], LANDING_SCHEMA)
        run_once(more, path, run, AS_OF, specs)
    assert latest_run(spark, path) == 3 and snapshot_scan(spark, path).count() == 4
    assert read_files(spark, path).where("run_id = 3").agg(F.sum("rows")).first()[0] == 4
    part = max((tmp_path / "snap" / "items" / "run_id=3").glob("part-*"), key=lambda p: p.stat().st_size)
    whole = part.read_bytes()
    # the same size and other content: only a look at the rows tells
    part.write_bytes(whole[:60] + bytes(b ^ 255 for b in whole[60:90]) + whole[90:])
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert is_whole(spark, path, 3) and not is_whole(spark, path, 3, contents=True)
    assert latest_run(spark, path, contents=True) == 2
    part.write_bytes(whole[:40])
    assert latest_run(spark, path) == 2 and snapshot_scan(spark, path).count() == 3
    part.unlink()
    assert latest_run(spark, path) == 2
    # a damaged record is no record
    record = next((tmp_path / "snap" / "runs" / "run_id=2").glob("part-*"))
    record.write_bytes(b"PAR1")
    (record.parent / f".{record.name}.crc").unlink(missing_ok=True)
    assert latest_run(spark, path) == 1
    run_once(more, path, 4, AS_OF, specs)
    assert {r["name"] for r in snapshot_scan(spark, path).collect()} == {"Item 0", "Item 1", "Item 3"}
    assert expire_runs(spark, path, keep=2) == [0] and latest_run(spark, path, before=4) == 1 and not (tmp_path / "snap" / "items" / "run_id=0").exists()


def test_feed_texts_are_worked_out_once(spark, landing):
    specs = [config.SourceSpec("TLDR AI", 0, "feed", 20, topic_filter=True), config.SourceSpec("The Rundown AI", 1, "feed", 20)]
    plan = collect(landing, AS_OF, specs)._jdf.queryExecution().optimizedPlan().toString()
    # the pattern of what isn't page text
    assert plan.count("script|style|template|rt|rp") == 1
