"""The `documents` and `pages` tables seen as items, and documents laid out as landed payloads.

Spark builds each payload from a bounded group: the documents of one source
within a block of BLOCK consecutive ids, as one feed, API answer or page.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from ..session import spread_small
from ..config import ARTICLE_CONTAINER_CLASS, SCRIPT_CHUNK_PREFIX, SourceSpec
from ..functions.text import constant

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
BLOCK = 500
NO_SOURCE = "none"
CLOCK = "10:00:00"

# kind of payload per source number, for the run over mixed sources
KINDS = ["product_feed", "hits", "posts", "embedded", "listing", "newsletter", "feed", "launch_feed", "title_feed", "sitemap"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spread_small(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def named_source() -> Column:
    return F.coalesce("source", F.lit(NO_SOURCE))


def source_names(docs: DataFrame) -> list[str]:
    """The sources of the documents in order; the number of a source is its place. A registry lists each once."""
    return sorted(r[0] for r in docs.select(named_source()).distinct().collect())


def item_docs(docs: DataFrame) -> DataFrame:
    """Documents as items: the first sentence is the name, five neighbours of a source share a url."""
    docs = docs.withColumn("source", named_source())
    slash = F.when(F.col("n_chars") % 3 == 0, "/").otherwise("")
    return docs.select(
        F.col("doc_id").alias("rank"),
        F.regexp_extract("text", r"^[^\n.]*", 0).alias("name"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.expr("cast(doc_id div 100 as string)"), slash).alias("tool_url"),
        "source", F.col("text").alias("description"), "lang", "n_chars", "doc_id")


def item_pages(pages: DataFrame) -> DataFrame:
    """Pages as items: title, url, and the host as source."""
    return pages.select(
        F.col("page_id").alias("rank"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("name"),
        F.col("url").alias("tool_url"),
        F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1)).alias("source"), "html")


def sources(names: list[str], kind: str | None = None, cap: int = 20) -> list[SourceSpec]:
    """The documents' sources as a registry: all of one kind, or of mixed kinds."""
    specs = []
    for n, name in enumerate(names):
        k = kind or KINDS[n % len(KINDS)]
        specs.append(SourceSpec(
            name, n, k, cap={"newsletter": 5}.get(k, cap), topic_filter=k == "feed" and n % 4 == 2,
            fallback_cap=15 if k == "posts" else None))
    return specs


def _escaped(text: Column) -> Column:
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def dated(docs: DataFrame) -> DataFrame:
    """Items with a day, their payload number and fields escaped for markup."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 45).cast("int"))
    rows = item_docs(docs).withColumns({
        "seq": F.expr("doc_id div 500"), "day": day,
        "rfc": F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(f" {CLOCK} +0000")),
        "iso": F.concat(day.cast("string"), F.lit(f"T{CLOCK}")),
        "epoch": F.unix_date(day).cast("bigint") * 86400 + 36000,
        "title_html": _escaped(F.col("name")), "text_html": _escaped(F.col("description")),
    })
    return rows


def _blocks(rows: DataFrame, *entry: Column) -> DataFrame:
    """Entries of each payload in document order. A group never holds more than BLOCK rows."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("doc_id"), *entry)))
    return rows.groupBy("source", "seq").agg(listed.alias("entries"))


def _land(blocks: DataFrame, kind: str, payload: Column, status: Column | None = None, url: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return blocks.select(
        "source", F.lit(kind).alias("kind"), "seq", (none if url is None else url).alias("url"),
        (F.lit("ok") if status is None else status).alias("status"), payload.alias("payload"))


def _rss(entries: str) -> Column:
    items = F.transform(entries, lambda e: F.struct(
        e["title"].alias("title"), e["link"].alias("link"), e["summary"].alias("description"), e["rfc"].alias("pubDate")))
    return F.to_xml(F.struct(F.struct(items.alias("item")).alias("channel")), {"rowTag": "rss"})


def _atom(entries: str) -> Column:
    items = F.transform(entries, lambda e: F.struct(
        e["title"].alias("title"), F.struct(e["link"].alias("_href"), F.lit("alternate").alias("_rel")).alias("link"),
        e["summary"].alias("summary"), e["rfc"].alias("updated")))
    return F.to_xml(F.struct(items.alias("entry")), {"rowTag": "feed"})


def land_feed(docs: DataFrame, atom: bool = False, title: Column | None = None) -> DataFrame:
    rows = dated(docs).withColumn("title", F.col("name") if title is None else title)
    summary = F.concat(F.lit("<p>"), "text_html", F.lit("</p>"))
    blocks = _blocks(rows, F.col("title"), F.col("tool_url").alias("link"), summary.alias("summary"), F.col("rfc"))
    return _land(blocks, "feed", _atom("entries") if atom else _rss("entries"))


def land_title_feed(docs: DataFrame) -> DataFrame:
    """Link feeds in which French and Spanish titles name a library."""
    return land_feed(docs, title=F.concat("name", F.when(F.col("lang").isin("fr", "es"), " library").otherwise("")))


def land_product_feed(docs: DataFrame) -> DataFrame:
    """Each entry has a directory link, then a link of its own, which for German ones is blocked too."""
    rows = dated(docs)
    own = F.concat(F.when(F.col("lang") == "de", "https://dev.to/").otherwise("https://tools.example.org/"), "doc_id")
    summary = F.concat(
        F.lit("<p>"), "text_html", F.lit('</p><a href="https://www.producthunt.com/r/'), "doc_id",
        F.lit('">Link</a> <a href="'), own, F.lit('">Site</a> Discussion | Link'))
    blocks = _blocks(rows, F.col("name").alias("title"), F.col("tool_url").alias("link"), summary.alias("summary"), F.col("rfc"))
    return _land(blocks, "feed", _rss("entries"))


def land_hits(docs: DataFrame) -> DataFrame:
    """Search hits, and the reply trees of the French ones, which have no text of their own."""
    rows = dated(docs).withColumn("author", F.concat(F.lit("user_"), "source"))
    hit = F.struct(
        F.concat(F.lit("Show HN: "), "name").alias("title"),
        F.concat("tool_url", F.when(F.col("lang") == "es", "/blog/").otherwise("")).alias("url"),
        F.col("epoch").alias("created_at_i"),
        F.when(F.col("lang") != "fr", F.concat(F.lit("<p>"), "text_html", F.lit("</p>"))).alias("story_text"),
        F.col("doc_id").cast("string").alias("objectID"), F.col("author"))
    blocks = _blocks(rows, hit.alias("hit"))
    hits = F.to_json(F.struct(F.transform("entries", lambda e: e["hit"]).alias("hits")))
    reply = lambda author, text: F.struct(author.alias("author"), text.alias("text"))
    tree = F.to_json(F.struct(F.array(
        reply(F.lit("other"), F.lit("first")), reply(F.col("author"), F.lit("")),
        reply(F.col("author"), F.concat(F.lit("<p>"), "text_html", F.lit("</p>"))),
        reply(F.col("author"), F.lit("late"))).alias("children")))
    replies = _land(rows.where(F.col("lang") == "fr"), "replies", tree, url=F.col("doc_id").cast("string"))
    return _land(blocks, "hits", hits).unionByName(replies)


def place_in(names: list[str]) -> Column:
    """The number of a row's source."""
    return F.try_element_at(constant({name: n for n, name in enumerate(names)}, "map<string,int>"), F.col("source"))


def land_posts(docs: DataFrame, failing: bool = True, garbled: bool = False, names: list[str] | None = None) -> DataFrame:
    """WordPress posts, some of whose fetches failed unless `failing` is off, and the feeds of the same sites.

    With `garbled` those fetches are marked as answered, with something that isn't a list of posts.
    """
    failed = (F.col("seq") + place_in(names or source_names(docs))) % 5 == 0 if failing else F.lit(False)
    rows = dated(docs)
    rendered = lambda c: F.struct(c.alias("rendered"))
    post = F.struct(
        rendered(F.concat(F.lit("<b>"), "title_html", F.lit("</b>"))).alias("title"),
        F.col("tool_url").alias("link"),
        rendered(F.concat(F.lit('<p><a href="https://github.com/x">Code</a>'), "text_html", F.lit("</p>"), F.when(
            F.col("lang") == "en", F.concat(F.lit("<a href='https://tools.example.org/"), "doc_id", F.lit("'>Go</a>"))).otherwise(""))).alias("content"),
        rendered(F.when(F.col("lang") == "fr", F.concat(F.lit("<p>"), "title_html", F.lit("</p>"))).otherwise(" ")).alias("excerpt"),
        F.col("iso").alias("date"))
    blocks = _blocks(rows, post.alias("post"))
    answer = F.to_json(F.transform("entries", lambda e: e["post"]))
    if garbled:
        page = F.lit("<html><body>Too many requests</body></html>")
        bad = F.when(F.col("seq") % 3 == 0, page).when(F.col("seq") % 3 == 1, F.substring(answer, 1, 60)).otherwise('{"code": "rest_forbidden", "data": {"status": 401}}')
        posts = _land(blocks, "posts", F.when(failed, bad).otherwise(answer))
    else:
        posts = _land(blocks, "posts", F.when(~failed, answer), F.when(failed, "failed").otherwise("ok"))
    return posts.unionByName(land_feed(docs))


def land_embedded(docs: DataFrame) -> DataFrame:
    """A page whose scripts hold one object each. Two neighbours of a source share a slug; German ones have no tier."""
    rows = dated(docs)
    in_script = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("")), F.lit('"'), F.lit('\\\\\\"'))
    slug = F.concat("source", F.lit("-"), F.expr("cast(doc_id div 40 as string)"))
    tier = F.when(F.col("lang") == "en", "free").when(F.col("lang") == "fr", "freemium").when(F.col("lang") == "es", "contact")
    pair = lambda key, value: F.concat(F.lit(f'\\"{key}\\":\\"'), value, F.lit('\\"'))
    tool = F.concat(
        pair("slug", slug), F.lit(","), pair("name", in_script(F.col("name"))), F.lit(","),
        pair("description_short", in_script(F.col("description"))), F.lit(","),
        pair("website_url", F.replace(F.col("tool_url"), F.lit("/"), F.lit("\\\\/"))), F.lit(","),
        F.coalesce(F.concat(pair("pricing_tier", tier), F.lit(",")), F.lit("")), pair("published_at", F.concat("iso", F.lit(".000Z"))))
    blocks = _blocks(rows, tool.alias("tool"))
    scripts = F.transform("entries", lambda e: F.concat(F.lit(f'<script>{SCRIPT_CHUNK_PREFIX}([1,"'), e["tool"], F.lit('"])</script>')))
    page = F.concat(F.lit("<html><body><script>var a=1</script>"), F.array_join(scripts, "\n"), F.lit("</body></html>"))
    return _land(blocks, "embedded", page)


def land_listing(docs: DataFrame) -> DataFrame:
    rows = dated(docs)
    tagline = F.when(F.col("lang") != "es", F.concat(F.lit('<span class="tools-name-tagline">'), "text_html", F.lit("</span>"))).otherwise("")
    row = F.concat(
        F.lit('<div class="row home-today-row" data-release-ts="'), F.col("epoch").cast("string"), F.lit('" data-href="'), "tool_url",
        F.lit('"><b><span class="home-today-name-text">'), "title_html", F.lit("</span></b>"), tagline, F.lit("</div>"))
    blocks = _blocks(rows, row.alias("row"))
    page = F.concat(F.lit("<html><body>"), F.array_join(F.transform("entries", lambda e: e["row"]), ""), F.lit("</body></html>"))
    return _land(blocks, "listing", page)


def land_newsletter(docs: DataFrame) -> DataFrame:
    """A feed of issues, and one page per issue with links that count and links that do not."""
    rows = dated(docs).withColumn("issue_url", F.concat(F.lit("https://letters.example.com/"), "doc_id"))
    blocks = _blocks(rows, F.col("name").alias("title"), F.col("issue_url").alias("link"), F.lit("").alias("summary"), F.col("rfc"))
    page = F.concat(
        F.lit('<p><a href="https://outside.example.com/">outside</a></p><div class="post gh-content"><p>👀 What\'s new: '),
        "text_html", F.lit(' <a href="'), "tool_url", F.lit('">'), "title_html", F.lit(" tool</a></p><ul><li>Again <a href='"), "tool_url",
        F.lit("/'>the same tool</a><li><a href=\"https://twitter.com/x\">a tweet</a></li><li>Read <a href=\"https://www.microsoft.com/"), "doc_id",
        F.lit('">at the maker</a></li></ul><a href="/local">local link</a><a href="https://short.example.com/">abc</a></div>'))
    return _land(blocks, "feed", _rss("entries")).unionByName(_land(rows, "page", page, url=F.col("issue_url")))


def land_sitemap(docs: DataFrame) -> DataFrame:
    """A sitemap, and the pages it lists: English ones have no description, German ones no properties at all."""
    rows = dated(docs).withColumn("page_url", F.concat(F.lit("https://"), "source", F.lit(".example.com/tool/my-tool-"), "doc_id"))
    blocks = _blocks(rows, F.struct(F.col("page_url").alias("loc"), F.concat("iso", F.lit("Z")).alias("lastmod")).alias("entry"))
    urls = F.to_xml(F.struct(F.transform("entries", lambda e: e["entry"]).alias("url")), {"rowTag": "urlset"})
    attribute = lambda c: F.replace(c, F.lit('"'), F.lit("&quot;"))
    title = F.when(F.col("lang") != "de", F.concat(F.lit('<meta property="og:title" content="'), attribute(F.col("title_html")), F.lit('">'))).otherwise("")
    described = F.when(F.col("lang").isin("fr", "es"), F.concat(
        F.lit('<meta content="'), attribute(F.col("text_html")), F.lit('" property="og:description"/>'))).otherwise("")
    page = F.concat(F.lit("<html><head>"), title, described, F.lit("</head></html>"))
    return _land(blocks, "sitemap", urls).unionByName(_land(rows, "page", page, url=F.col("page_url")))


LANDERS = {
    "feed": land_feed, "launch_feed": land_feed, "title_feed": land_title_feed, "product_feed": land_product_feed, "hits": land_hits,
    "posts": land_posts, "embedded": land_embedded, "listing": land_listing, "newsletter": land_newsletter, "sitemap": land_sitemap,
}


def land_mixed(docs: DataFrame) -> DataFrame:
    """All documents landed, every source as the kind that `sources()` gives it."""
    names = source_names(docs)
    specs, landed = sources(names), None
    for kind, lander in LANDERS.items():
        own = docs.where(named_source().isin([s.name for s in specs if s.kind == kind]))
        part = lander(own, names=names) if kind == "posts" else lander(own)
        landed = part if landed is None else landed.unionByName(part)
    return landed


DEFECTS = 5


def defect(names: list[str]) -> Column:
    """What is wrong with a dirty payload: 0 nothing, 1 blank lines before the declaration, 2 bare ampersands and references
    that XML doesn't know, 3 one entry whose tags don't match, 4 the end cut off within the last entry."""
    return (F.col("seq") + place_in(names)) % DEFECTS


def _dirty(blocks: DataFrame, names: list[str], head: str, entry, tail: str, title: str) -> Column:
    """`entry` gives an entry's markup between its tags."""
    kind = defect(names)

    def one(e: Column, i: Column) -> Column:
        whole = F.concat(F.lit(f"<{title}>"), entry(e, kind), F.lit(f"</{title}>"))
        broken = F.concat(F.lit(f"<{title}><b>"), entry(e, kind), F.lit(f"</{title}>"))
        cut = F.concat(F.lit(f"<{title}>"), F.substring(entry(e, kind), 1, 20))
        return F.when((kind == 3) & (i == 1), broken).when((kind == 4) & (i == F.size("entries") - 1), cut).otherwise(whole)

    body = F.array_join(F.transform("entries", one), "\n")
    declared = F.concat(F.when(kind == 1, "\n \n").otherwise(""), F.lit('<?xml version="1.0" encoding="UTF-8"?>'), F.lit(head), body)
    return F.concat(declared, F.when(kind == 4, "").otherwise(tail))


def land_dirty_feed(docs: DataFrame) -> DataFrame:
    """Feeds, four of five with a defect. The text is in a CDATA section, ampersands and all."""
    names = source_names(docs)
    rows = dated(docs)
    blocks = _blocks(rows, F.col("title_html").alias("title"), F.col("tool_url").alias("link"), F.col("text_html").alias("text"), F.col("rfc"))

    def entry(e: Column, kind: Column) -> Column:
        title = F.concat(e["title"], F.when(kind == 2, " R&D &eacute;t&eacute; &amp; AT&T; a < b &#233;").otherwise(""))
        return F.concat(F.lit("<title>"), title, F.lit("</title><link>"), e["link"], F.lit("</link><description><![CDATA[<p>"), e["text"],
                        F.lit(" R&D &eacute; &amp;</p>]]></description><pubDate>"), e["rfc"], F.lit("</pubDate>"))

    return _land(blocks, "feed", _dirty(blocks, names, '<rss version="2.0"><channel><title>feed</title>', entry, "</channel></rss>", "item"))


def land_dirty_sitemap(docs: DataFrame) -> DataFrame:
    """Sitemaps, four of five with a defect."""
    names = source_names(docs)
    rows = dated(docs).withColumn("page_url", F.concat(F.lit("https://"), "source", F.lit(".example.com/tool?id="), "doc_id"))
    blocks = _blocks(rows, F.col("page_url").alias("loc"), F.concat("iso", F.lit("Z")).alias("lastmod"))

    def entry(e: Column, kind: Column) -> Column:
        return F.concat(F.lit("<loc>"), e["loc"], F.when(kind == 2, "&x=1").otherwise(""), F.lit("</loc><lastmod>"), e["lastmod"], F.lit("</lastmod>"))

    return _land(blocks, "sitemap", _dirty(blocks, names, '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', entry, "</urlset>", "url"))
