"""Registered queries: each operator over the given tables, with its restatement in SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import config
from ..functions import dates as D, html as H, text as X
from ..operators import dedup, items as I, joins as J, terms as M, triage as T
from ..sources import payloads as S
from ..sources.bucketed import bucketed_scan, bucketed_stats, merge_into_buckets
from ..sources.combine import source_fallback, union_sources
from . import oracle as O, samples
from ..session import cut_lineage, shared_folder
from ..sources.snapshot import snapshot_scan, write_files, write_run_stats, write_snapshot
from ..streaming.increment import TRIAGE_EVENT_SCHEMA, collect_increment, fold_triage, keep_triage, read_landing, read_triage
from .collect import collect
from .nightly import merge_run
from .samples import AS_OF, item_docs, item_pages, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RANK = ["rank"]
TEST_URL_DOMAINS = ["spam-farm.example.org"]
TEST_HOST_DOMAINS = ["cheap-pills.example.com", "th.example.net"]


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return item_docs(table(spark, sf, "documents"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return item_pages(table(spark, sf, "pages"))


def _line(column: str = "categories") -> Column:
    return F.array_join(column, ",").alias(column)


def _flat(items: DataFrame) -> DataFrame:
    return items.select(*[F.col(c).cast("bigint").alias(c) for c in ("source_rank", "seq", "pos")],
                        "name", "tool_url", "description", "source", "date_iso", _line(), "pricing")


# --- Scalar functions ---

BARE = "CASE WHEN starts_with(url, 'https') THEN url ELSE '  ' || regexp_replace(url, '^http://', '') || ' ' END"


@query("norm_url", f"SELECT page_id, {O.norm_url(BARE)} AS tool_url FROM pages")
def _norm_url(spark, sf):
    url = F.col("url")
    bare = F.when(url.startswith("https"), url).otherwise(F.concat(F.lit("  "), F.regexp_replace(url, "^http://", ""), F.lit(" ")))
    return table(spark, sf, "pages").select("page_id", X.norm_url(bare).alias("tool_url"))


@query("dedup_keys", f"WITH {O.PAGES} SELECT rank, {O.url_key('tool_url')} AS url_key, {O.name_key('name')} AS name_key FROM pgs")
def _dedup_keys(spark, sf):
    return dedup.with_keys(_pages(spark, sf)).select("rank", "url_key", "name_key")


SP = O.SPACE


@query("clean_text", f"""WITH {O.DOCS} SELECT rank, {O.collapse('description')} AS collapsed,
    regexp_replace(name, {O.lit(f"^{O.W}*[A-Za-z][" + chr(92) + "p{L}" + chr(92) + "p{N}_' ]{0,30}:" + SP + "*")}, '') AS label_free,
    regexp_replace('Show hn  - ' || name, {O.lit(f'(?i)^show hn{SP}*[:-]{SP}*')}, '') AS show_free,
    {O.strip(f"regexp_replace(description || ' Discussion  | Link', {O.lit('Discussion' + SP + '*' + chr(92) + '|' + SP + '*Link')}, '', 'g')")} AS tail_free
    FROM docs""")
def _clean_text(spark, sf):
    return _docs(spark, sf).select(
        "rank", X.collapse_whitespace(F.col("description")).alias("collapsed"), X.clean_leading_label(F.col("name")).alias("label_free"),
        X.clean_show_prefix(F.concat(F.lit("Show hn  - "), "name")).alias("show_free"),
        X.clean_discussion_tail(F.concat("description", F.lit(" Discussion  | Link"))).alias("tail_free"))


@query("truncate_text", f"WITH {O.DOCS} SELECT rank, left(name, 100) AS name_cut, left(description, 400) AS description_cut, left(name, 80) AS hit_cut, left(description, 300) AS excerpt_cut FROM docs")
def _truncate(spark, sf):
    name, text = F.col("name"), F.col("description")
    return _docs(spark, sf).select(
        "rank", X.truncate_text(name, config.NAME_CHARS).alias("name_cut"), X.truncate_text(text, config.DESCRIPTION_CHARS).alias("description_cut"),
        X.truncate_text(name, config.HIT_NAME_CHARS).alias("hit_cut"), X.truncate_text(text, config.EXCERPT_CHARS).alias("excerpt_cut"))


@query("guess_pricing", f"SELECT doc_id, {O.pricing('text')} AS pricing FROM documents")
def _guess_pricing(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.guess_pricing(F.col("text")).alias("pricing"))


@query("guess_pricing_whole_word", f"SELECT doc_id, {O.pricing('text', O.any_word)} AS pricing FROM documents")
def _guess_pricing_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.guess_pricing(F.col("text"), whole_word=True).alias("pricing"))


@query("categories", f"SELECT doc_id, {O.categories('text', O.TEST_CATEGORIES)} AS categories FROM documents")
def _categories(spark, sf):
    found = X.guess_categories(F.col("text"), O.TEST_CATEGORIES)
    return table(spark, sf, "documents").select("doc_id", F.array_join(found, ",").alias("categories"))


@query("categories_default", f"SELECT doc_id, {O.categories('text')} AS categories FROM documents")
def _categories_default(spark, sf):
    found = X.guess_categories(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(found, ",").alias("categories"))


@query("listicle", f"""WITH {O.DOCS} SELECT rank, {O.listicle("'Top ' || n_chars || ' ' || name || ' tools'")} AS top_list,
    {O.listicle("n_chars || ' ' || name || ' prompt'")} AS plain_list, {O.listicle('name')} AS own FROM docs""")
def _listicle(spark, sf):
    n = F.col("n_chars").cast("string")
    return _docs(spark, sf).select(
        "rank", X.is_listicle(F.concat(F.lit("Top "), n, F.lit(" "), "name", F.lit(" tools"))).alias("top_list"),
        X.is_listicle(F.concat(n, F.lit(" "), "name", F.lit(" prompt"))).alias("plain_list"), X.is_listicle(F.col("name")).alias("own"))


@query("topic_filter", f"""WITH {O.DOCS} SELECT rank, name FROM docs
    WHERE {O.any_of("lower(name || ' ' || description)", config.TOPIC_TERMS)} AND {O.any_of("lower(name || ' ' || description)", config.PRODUCT_TOPIC_TERMS)}""")
def _topic_filter(spark, sf):
    text = F.concat_ws(" ", "name", "description")
    return _docs(spark, sf).where(X.topic_filter(text) & X.topic_filter(text, config.PRODUCT_TOPIC_TERMS)).select("rank", "name")


SHOW_URL = "(tool_url || CASE lang WHEN 'de' THEN '/wiki/' WHEN 'es' THEN 'x.md' WHEN 'fr' THEN '?u=news.ycombinator.com' ELSE '' END)"


@query("show_filter", f"""WITH {O.DOCS} SELECT rank, name, {SHOW_URL} AS url FROM docs
    WHERE NOT contains({SHOW_URL}, 'ycombinator.com') AND NOT {O.any_of(f'lower({SHOW_URL})', config.SHOW_PATH_MARKERS)}
    AND {O.any_of('lower(name)', config.SHOW_TITLE_TERMS)} AND NOT {O.any_of('lower(name)', config.SHOW_ARTICLE_PHRASES)} AND NOT {O.listicle('name')}""")
def _show_filter(spark, sf):
    lang = F.col("lang")
    end = F.when(lang == "de", "/wiki/").when(lang == "es", "x.md").when(lang == "fr", "?u=news.ycombinator.com").otherwise("")
    rows = _docs(spark, sf).select("rank", "name", F.concat("tool_url", end).alias("url"))
    return rows.where(X.show_filter(F.col("name"), F.col("url")))


@query("launch_filter", f"""WITH {O.DOCS} SELECT rank, {O.any_of("lower(name || ' ' || description)", config.LAUNCH_TERMS)} AS in_text,
    {O.any_of("lower(description)", config.LAUNCH_TITLE_TERMS)} AS in_title FROM docs""")
def _launch_filter(spark, sf):
    return _docs(spark, sf).select(
        "rank", X.launch_filter(F.concat_ws(" ", "name", "description")).alias("in_text"),
        X.launch_filter(F.col("description"), config.LAUNCH_TITLE_TERMS).alias("in_title"))


@query("min_length", f"WITH {O.DOCS} SELECT rank, name FROM docs WHERE length({O.strip('name')}) >= 12")
def _min_length(spark, sf):
    return _docs(spark, sf).where(X.min_length(F.col("name"), 12)).select("rank", "name")


@query("excerpt_fallback", f"""WITH {O.DOCS} SELECT rank, CASE WHEN lang <> 'en' AND {O.strip('name')} <> '' THEN name ELSE left(description, 300) END AS excerpt FROM docs""")
def _excerpt(spark, sf):
    excerpt = F.when(F.col("lang") != "en", F.col("name")).otherwise("  \n")
    return _docs(spark, sf).select("rank", X.excerpt_fallback(excerpt, F.col("description")).alias("excerpt"))


@query("pricing_tier", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'paid' WHEN event_type = 'signup' THEN 'freemium' WHEN event_type = 'view' THEN 'free' ELSE 'unknown' END AS pricing FROM events")
def _tier(spark, sf):
    kind = F.col("event_type")
    tier = F.when(kind == "purchase", "paid").when(kind == "signup", "freemium").when(kind == "view", "free").otherwise(kind)
    return table(spark, sf, "events").select("event_id", X.map_pricing_tier(tier).alias("pricing"))


# --- Dates. Each event type writes its time in another form. ---

def _written(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    day, clock = F.to_date("ts"), F.date_format("ts", "HH:mm:ss")
    iso = F.concat(day.cast("string"), F.lit("T"), clock)
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.date_format(day, "EEE, dd MMM yyyy "), clock, F.lit(" +0000")))
        .when(kind == "click", F.concat(iso, F.lit("Z")))
        .when(kind == "signup", iso)
        .when(kind == "error", F.concat(F.date_format(day, "EEE, dd MMM yyyy "), clock, F.lit(" GMT")))
        .otherwise(day.cast("string")))
    return events.select("event_id", text.alias("written"))


EVENT_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
STRICT = f"""CASE event_type WHEN 'view' THEN {EVENT_ISO} || '+00:00' WHEN 'click' THEN {EVENT_ISO} || '+00:00'
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT00:00:00') END"""
LENIENT = f"""CASE event_type WHEN 'signup' THEN {EVENT_ISO} WHEN 'error' THEN {EVENT_ISO} || '+00:00' ELSE {STRICT} END"""
MOMENT = "CASE WHEN event_type = 'purchase' THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END"


@query("parse_date", f"SELECT event_id, {STRICT} AS strict, {LENIENT} AS lenient FROM events")
def _parse_date(spark, sf):
    written = F.col("written")
    return _written(spark, sf).select("event_id", D.parse_date(written, parity=True).alias("strict"), D.parse_date(written).alias("lenient"))


@query("recent", f"""SELECT event_id, {LENIENT} AS date_iso FROM events WHERE {MOMENT} >= TIMESTAMP '2024-01-24 00:00:00'""")
def _recent(spark, sf):
    rows = _written(spark, sf).select("event_id", D.parse_date(F.col("written")).alias("date_iso"))
    return rows.where(D.is_recent(F.col("date_iso"), AS_OF))


@query("epoch_iso", f"SELECT event_id, {EVENT_ISO} || '+00:00' AS date_iso FROM events")
def _epoch(spark, sf):
    seconds = F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    return table(spark, sf, "events").select("event_id", D.epoch_to_iso(seconds).alias("date_iso"))


# --- Pages ---

OG = "starts_with(url, 'https')"
SLUG = "[upper(left(w, 1)) || lower(substring(w, 2)) FOR w IN string_split(replace(list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1), '-', ' '), ' ')]"


@query("page_meta", f"""WITH {O.PAGES} SELECT page_id, CASE WHEN {OG} THEN {O.strip("replace(pgs.name, '&amp;', '&')")} ELSE array_to_string({SLUG}, ' ') END AS title,
    CASE WHEN {OG} THEN source ELSE '' END AS description FROM pages JOIN pgs ON rank = page_id""")
def _page_meta(spark, sf):
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    host = X.url_host(F.col("url"))
    og = F.concat(F.lit('<head><meta property="og:title" content="'), title, F.lit("\"><meta content='"), host, F.lit("' property='og:description'>"))
    html = F.when(F.col("url").startswith("https"), F.replace("html", F.lit("<head>"), og)).otherwise(F.col("html"))
    pages = table(spark, sf, "pages").select("page_id", "url", html.alias("payload"))
    return S.page_meta_scan(pages).select("page_id", "title", "description")


ANCHORS = r"""a AS (SELECT page_id, url, CAST(unnest(range(len(m))) AS BIGINT) AS pos, unnest(m) AS tag FROM (
    SELECT page_id, url, regexp_extract_all(html, '<a [^>]*>[^<]*</a>') AS m FROM pages)),
  links AS (SELECT page_id, url, pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href,
    trim(regexp_extract(tag, '>([^<]*)<', 1)) AS text FROM a)"""


def _payloads(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select(X.url_host(F.col("url")).alias("source"), F.col("page_id").alias("seq"), "url", F.col("html").alias("payload"))


@query("anchors", f"WITH {ANCHORS} SELECT page_id, pos, href, text FROM links")
def _anchors(spark, sf):
    return S.anchor_scan(_payloads(spark, sf)).select(F.col("seq").alias("page_id"), "pos", "href", "text")


@query("anchors_in_context", f"WITH {ANCHORS} SELECT page_id, pos, href, text, text AS context FROM links")
def _context(spark, sf):
    return S.anchor_scan(_payloads(spark, sf), context=True).select(F.col("seq").alias("page_id"), "pos", "href", "text", "context")


MARKED = r"""regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<![^>]*>', chr(1), 'g'),
    '</?[A-Za-z][^>]*>', chr(1), 'g'), '&quot;', '"', 'g')"""
DECODED = f"replace(replace(replace({MARKED}, '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')"


@query("html_text", f"""SELECT page_id, array_to_string([{O.strip('n')} FOR n IN string_split({DECODED}, chr(1)) IF {O.strip('n')} <> ''], ' ') AS text FROM pages""")
def _html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.html_to_text(F.col("html")).alias("text"))


@query("first_link", f"""WITH {ANCHORS}, f AS (SELECT page_id, arg_min(href, pos) AS href FROM links WHERE starts_with(href, '/th') GROUP BY page_id)
    SELECT p.page_id, coalesce(f.href, p.url) AS link FROM pages p LEFT JOIN f ON f.page_id = p.page_id""")
def _first_link(spark, sf):
    link = H.first_external_link(F.col("html"), lambda h: h.startswith("/th"), F.col("url"))
    return table(spark, sf, "pages").select("page_id", link.alias("link"))


BLOCKED = config.DIRECTORY_DOMAINS + ["spam-farm.example.org", "cheap-pills.example.com", "ththth.example.net"]
HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"


@query("is_external", f"""SELECT page_id, NOT {O.any_of(f"regexp_replace({HOST}, '^www[.]', '')", BLOCKED)} AS plain,
    NOT {O.any_of(f"regexp_replace({HOST}, '^[w.]+', '')", BLOCKED)} AS parity,
    NOT ({' OR '.join(f"{HOST} = {O.lit(b)} OR ends_with({HOST}, {O.lit('.' + b)})" for b in BLOCKED)}) AS by_suffix FROM pages""")
def _is_external(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", X.is_external(url, BLOCKED).alias("plain"), X.is_external(url, BLOCKED, parity=True).alias("parity"),
        X.is_external(url, BLOCKED, match="suffix").alias("by_suffix"))


def _links(spark, sf) -> DataFrame:
    """Anchors resolved against their page's host."""
    host = F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    links = _payloads(spark, sf).select(F.col("seq").alias("page_id"), host.alias("root"), F.posexplode(H.hrefs(F.col("payload"))).alias("pos", "href"))
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.concat("root", "href").alias("href"))


RESOLVED = r"r AS (SELECT page_id, pos, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href AS href, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host FROM links)"


@query("blocklist_anti", f"""WITH {ANCHORS}, {RESOLVED} SELECT page_id, pos, href FROM r
    WHERE NOT {O.any_of('lower(href)', TEST_URL_DOMAINS)} AND NOT {O.any_of('host', TEST_HOST_DOMAINS)}""")
def _blocklist(spark, sf):
    return J.blocklist_anti(_links(spark, sf), "href", TEST_URL_DOMAINS, TEST_HOST_DOMAINS, match="contains")


@query("blocklist_anti_suffix", f"""WITH {ANCHORS}, {RESOLVED} SELECT page_id, pos, href FROM r
    WHERE NOT ({' OR '.join(f"host = {O.lit(b)} OR ends_with(host, {O.lit('.' + b)})" for b in TEST_URL_DOMAINS + TEST_HOST_DOMAINS)})""")
def _blocklist_suffix(spark, sf):
    return J.blocklist_anti(_links(spark, sf), "href", TEST_URL_DOMAINS, TEST_HOST_DOMAINS)


LISTED = r"listed AS (SELECT DISTINCT lower(regexp_extract(url, '([^./]+[.][^./]+[.][a-z]+)(/|$)', 1)) AS domain FROM pages WHERE starts_with(url, 'http:'))"


@query("blocklist_anti_table", f"""WITH {ANCHORS}, {RESOLVED}, {LISTED} SELECT page_id, pos, href FROM r
    WHERE NOT EXISTS (SELECT 1 FROM listed WHERE host = domain OR ends_with(host, '.' || domain))""")
def _blocklist_table(spark, sf):
    pages = table(spark, sf, "pages").where(F.col("url").startswith("http:"))
    listed = pages.select(F.lower(F.regexp_extract("url", r"([^./]+[.][^./]+[.][a-z]+)(/|$)", 1)).alias("domain"))
    return J.blocklist_anti_table(_links(spark, sf), listed).select("page_id", "pos", "href")


@query("blocklist_contains_table", rf"""WITH {ANCHORS}, {RESOLVED},
    listed AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{7,}}')) AS domain FROM benchmark)
    SELECT page_id, pos, href FROM r WHERE NOT EXISTS (SELECT 1 FROM listed WHERE contains(lower(href), domain))""")
def _blocklist_contains_table(spark, sf):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{7,}"), F.lit(0))
    listed = table(spark, sf, "benchmark").select(F.explode(words).alias("domain"))
    return M.blocklist_contains_table(_links(spark, sf), listed).select("page_id", "pos", "href")


@query("categories_table", rf"""WITH terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}|[a-z]+ [a-z]+')) AS term FROM benchmark),
    parts AS (SELECT doc_id, string_split(unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_ ]+|  +')), ' ') AS w FROM documents),
    runs AS (SELECT DISTINCT doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM parts),
    hits AS (SELECT doc_id, left(term, 2) AS label, ascii(term) AS rank FROM runs JOIN terms USING (term)),
    labels AS (SELECT doc_id, list(DISTINCT {{'rank': rank, 'label': label}}) AS found FROM hits GROUP BY doc_id)
    SELECT doc_id, coalesce(array_to_string([f.label FOR f IN list_slice(list_sort(found), 1, 3)], ','), '') AS categories
    FROM documents LEFT JOIN labels USING (doc_id)""")
def _categories_table(spark, sf):
    """The first three of the categories whose words, or pairs of words, a document holds; a category is a beginning of two letters."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}|[a-z]+ [a-z]+"), F.lit(0))
    terms = table(spark, sf, "benchmark").select(F.explode(words).alias("term")).select("term", F.ascii("term").alias("rank"), F.left("term", F.lit(2)).alias("label"))
    return M.guess_categories_table(table(spark, sf, "documents"), F.col("text"), terms, limit=3).select("doc_id", _line())


# --- Items and deduplication ---

@query("make_item", f"WITH {O.PAGES} SELECT rank, {O.item('name', 'tool_url', 'html', 'source', O.lit(O.AS_OF_ISO))} FROM pgs")
def _make_item(spark, sf):
    pages = _pages(spark, sf)
    fields = I.item_columns(F.col("name"), F.col("tool_url"), F.col("html"), F.col("source"), F.lit(None).cast("string"), AS_OF.isoformat())
    return pages.select("rank", *fields).withColumn("categories", _line())


@query("make_item_docs", f"WITH {O.DOCS} SELECT rank, {O.item('name', 'tool_url', 'description', 'source', O.lit('2024-01-02'))} FROM docs")
def _make_item_docs(spark, sf):
    fields = I.item_columns(F.col("name"), F.col("tool_url"), F.col("description"), F.col("source"), F.lit("2024-01-02"), AS_OF.isoformat())
    return _docs(spark, sf).select("rank", *fields).withColumn("categories", _line())


@query("distinct_first", f"WITH {O.DOCS} SELECT min(rank) AS rank, tool_url FROM docs GROUP BY tool_url")
def _distinct_first(spark, sf):
    return dedup.distinct_first(_docs(spark, sf), order=RANK).select("rank", "tool_url")


@query("distinct_links", f"""WITH {ANCHORS} SELECT page_id, arg_min(href, pos) AS href, min(pos) AS pos FROM links GROUP BY page_id, {O.url_key('href')}""")
def _distinct_links(spark, sf):
    links = S.anchor_scan(_payloads(spark, sf))
    return dedup.distinct_links_per_article(links, ["seq"]).select(F.col("seq").alias("page_id"), "href", "pos")


PAGE_EDGES = f"t AS (SELECT rank AS r, source AS u, {O.name_key('name')} AS n FROM pgs)"


@query("greedy_dedup", f"WITH RECURSIVE {O.PAGES}, {PAGE_EDGES}, {O.greedy('g', 't')} SELECT rank, name, source FROM pgs JOIN g ON r = rank")
def _greedy(spark, sf):
    return dedup.greedy_dedup(dedup.with_keys(_pages(spark, sf)), RANK, url="source").select("rank", "name", "source")


@query("greedy_dedup_docs", f"WITH RECURSIVE {O.DOCS}, {O.keyed('t', 'docs')}, {O.greedy('g', 't')} SELECT rank, name, tool_url, description FROM docs JOIN g ON r = rank")
def _greedy_docs(spark, sf):
    return dedup.greedy_dedup(dedup.with_keys(_docs(spark, sf)), RANK).select("rank", "name", "tool_url", "description")


CHAIN = """t AS (SELECT rank AS r, source || '-' || ((k + 1) // 2) AS u, source || '-' || (k // 2) AS n
    FROM (SELECT rank, source, row_number() OVER (PARTITION BY source ORDER BY rank) AS k FROM docs))"""


@query("greedy_dedup_chains", f"WITH RECURSIVE {O.DOCS}, {CHAIN}, {O.greedy('g', 't')} SELECT rank, u AS url_key, n AS name_key FROM t JOIN docs ON rank = r JOIN g USING (r)")
def _greedy_chains(spark, sf):
    """Each source's documents as one chain, in which a row's fate hangs on the row before it."""
    number = F.row_number().over(Window.partitionBy("source").orderBy("rank"))
    rows = _docs(spark, sf).select("rank", "source", number.alias("k"))
    key = lambda k: F.concat("source", F.lit("-"), F.expr(f"cast(({k}) div 2 as string)"))
    return dedup.greedy_dedup(rows.select("rank", key("k + 1").alias("url_key"), key("k").alias("name_key")), RANK).select("rank", "url_key", "name_key")


# Fresh rows are the English documents, previous ones all others.

SPLIT = f"{O.keyed('tf', 'docs', 'lang = ' + O.lit('en'))}, {O.greedy('gf', 'tf')}, {O.keyed('tp', 'docs', 'lang IS DISTINCT FROM ' + O.lit('en'))}, {O.greedy('gp', 'tp')}"
MERGED = f"""{SPLIT}, fr AS (SELECT * FROM tf WHERE r IN (SELECT r FROM gf)), pv AS (SELECT * FROM tp WHERE r IN (SELECT r FROM gp)),
    merged AS (SELECT r FROM fr UNION ALL SELECT r FROM pv WHERE u NOT IN (SELECT u FROM fr) AND n NOT IN (SELECT n FROM fr))"""


def _fresh_and_previous(spark, sf) -> tuple[DataFrame, DataFrame]:
    docs = dedup.with_keys(_docs(spark, sf))
    return dedup.greedy_dedup(docs.where("lang = 'en'"), RANK), dedup.greedy_dedup(docs.where("not lang <=> 'en'"), RANK)


@query("merge", f"WITH RECURSIVE {O.DOCS}, {MERGED} SELECT rank, name, tool_url, source FROM docs WHERE rank IN (SELECT r FROM merged) AND length({O.strip('name')}) >= 3")
def _merge(spark, sf):
    fresh, previous = _fresh_and_previous(spark, sf)
    return dedup.finalize_snapshot(dedup.cumulative_merge(fresh, previous)).select("rank", "name", "tool_url", "source")


# the greedy rule over both sides at once, fresh rows first, gives the same rows
@query("merge_unclean", f"WITH RECURSIVE {O.DOCS}, {MERGED} SELECT rank, name, tool_url, source FROM docs WHERE rank IN (SELECT r FROM merged)")
def _merge_unclean(spark, sf):
    fresh, previous = _fresh_and_previous(spark, sf)
    return dedup.cumulative_merge(fresh, previous, assume_clean=False, order=RANK).select("rank", "name", "tool_url", "source")


@query("never_seen", f"WITH RECURSIVE {O.DOCS}, {MERGED} SELECT rank, tool_url FROM docs WHERE rank IN (SELECT r FROM fr WHERE u NOT IN (SELECT u FROM pv))")
def _never_seen(spark, sf):
    fresh, previous = _fresh_and_previous(spark, sf)
    return I.never_seen(fresh, previous).select("rank", "tool_url")


@query("run_stats", f"""WITH RECURSIVE {O.DOCS}, {MERGED} SELECT {O.lit(O.AS_OF_ISO)} AS generated_at,
    (SELECT count(*) FROM merged JOIN docs ON rank = r WHERE length({O.strip('name')}) >= 3) AS count,
    (SELECT count(*) FROM fr WHERE u NOT IN (SELECT u FROM pv)) AS new_today""")
def _run_stats(spark, sf):
    fresh, previous = _fresh_and_previous(spark, sf)
    snapshot = dedup.finalize_snapshot(dedup.cumulative_merge(fresh, previous))
    return I.run_stats(snapshot, fresh, previous, AS_OF.isoformat())


def _merged_in_buckets(spark, sf) -> tuple[DataFrame, str]:
    """The previous rows as run 0 and the fresh ones as run 1 of a store in buckets; what its rows look like, and its path."""
    path = _new_folder(spark)
    fresh, previous = _fresh_and_previous(spark, sf)
    merge_into_buckets(previous, path, 0, AS_OF.isoformat())
    merge_into_buckets(fresh, path, 1, AS_OF.isoformat())
    return fresh, path


@query("merge_buckets", f"WITH RECURSIVE {O.DOCS}, {MERGED} SELECT rank, name, tool_url, source FROM docs WHERE rank IN (SELECT r FROM merged) AND length({O.strip('name')}) >= 3")
def _merge_buckets(spark, sf):
    like, path = _merged_in_buckets(spark, sf)
    return bucketed_scan(like, path).select("rank", "name", "tool_url", "source")


@query("run_stats_buckets", f"""WITH RECURSIVE {O.DOCS}, {MERGED} SELECT {O.lit(O.AS_OF_ISO)} AS generated_at,
    (SELECT count(*) FROM merged JOIN docs ON rank = r WHERE length({O.strip('name')}) >= 3) AS count,
    (SELECT count(*) FROM fr WHERE u NOT IN (SELECT u FROM pv JOIN docs ON rank = r WHERE length({O.strip('name')}) >= 3)) AS new_today""")
def _stats_buckets(spark, sf):
    return bucketed_stats(spark, _merged_in_buckets(spark, sf)[1]).where("run_id = 1").drop("run_id")


@query("newest_first", f"SELECT event_id, {LENIENT} AS date_iso FROM events ORDER BY date_iso DESC, event_id")
def _newest_first(spark, sf):
    rows = _written(spark, sf).select("event_id", D.parse_date(F.col("written")).alias("date_iso"))
    return I.newest_first(rows, ["event_id"])


@query("cap_per_source", f"""WITH {O.DOCS} SELECT rank, source, name FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank) AS k FROM docs
    WHERE NOT {O.listicle('name')}) WHERE k <= 20""")
def _cap(spark, sf):
    rows = _docs(spark, sf).where(~X.is_listicle(F.col("name")))
    return I.cap_per_source(rows, 20, ["source"], RANK).select("rank", "source", "name")


@query("by_source", "SELECT source, count(*) AS items FROM documents GROUP BY source")
def _by_source(spark, sf):
    return I.count_by_source(table(spark, sf, "documents"))


@query("by_pricing", f"SELECT pricing, count(*) AS items FROM (SELECT {O.pricing('text')} AS pricing FROM documents) GROUP BY pricing")
def _by_pricing(spark, sf):
    return I.count_by_pricing(table(spark, sf, "documents").select(X.guess_pricing(F.col("text")).alias("pricing")))


@query("catalog_by_source", f"""WITH RECURSIVE {O.PAGES}, k AS (SELECT * FROM pgs WHERE NOT {O.listicle('name')}),
    {O.keyed('t', 'k')}, {O.greedy('g', 't')} SELECT source, pricing, count(*) AS items FROM (
    SELECT source, {O.pricing("name || ' ' || html")} AS pricing FROM k JOIN g ON r = rank) GROUP BY source, pricing""")
def catalog_by_source(spark, sf):
    """Pages as items, without listicles, deduplicated, counted by source and pricing."""
    rows = _pages(spark, sf).where(~X.is_listicle(F.col("name")))
    fields = I.item_columns(F.col("name"), F.col("tool_url"), F.col("html"), F.col("source"), F.lit(None).cast("string"), AS_OF.isoformat())
    kept = dedup.greedy_dedup(dedup.with_keys(rows.select("rank", *fields)), RANK)
    return kept.groupBy("source", "pricing").agg(F.count("*").alias("items"))


# --- Lookups and combined sources ---

@query("first_reply", """WITH s AS (SELECT conv_id, CASE role WHEN 'system' THEN 'user' ELSE 'assistant' END AS author,
      CASE role WHEN 'user' THEN '' ELSE text END AS description FROM conversations WHERE turn = 0),
    f AS (SELECT conv_id, role, arg_min(text, turn) AS reply FROM conversations WHERE text <> '' GROUP BY conv_id, role)
    SELECT s.conv_id AS story_id, author, CASE WHEN description = '' THEN coalesce(reply, '') ELSE description END AS description
    FROM s LEFT JOIN f ON f.conv_id = s.conv_id AND f.role = s.author""")
def _first_reply(spark, sf):
    turns = table(spark, sf, "conversations")
    stories = turns.where("turn = 0").select(
        F.col("conv_id").alias("story_id"), F.when(F.col("role") == "system", "user").otherwise("assistant").alias("author"),
        F.when(F.col("role") == "user", "").otherwise(F.col("text")).alias("description"))
    replies = turns.select(F.col("conv_id").alias("story_id"), F.col("turn").alias("pos"), F.col("role").alias("author"), "text")
    return J.first_author_reply(stories, replies).select("story_id", "author", "description")


@query("lookup_slug", """SELECT d.doc_id, d.source, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN (
    SELECT doc_id, arg_max(quality, (quality, toxic)) AS quality, arg_max(toxic, (quality, toxic)) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id""")
def _lookup(spark, sf):
    labels = J.last_by_slug(table(spark, sf, "labels").withColumn("pos", F.struct("quality", "toxic")), ["quality", "toxic"], ["doc_id"])
    return J.lookup_by_slug(table(spark, sf, "documents").select("doc_id", "source"), labels, {"quality": -1, "toxic": 0}, ["doc_id"])


FAILED = "failed AS (SELECT source FROM documents GROUP BY source HAVING min(n_chars) < 12)"


@query("source_fallback", f"""WITH {FAILED} SELECT doc_id, source, text, 'answer' AS via FROM documents WHERE source IS NULL OR source NOT IN (SELECT source FROM failed WHERE source IS NOT NULL)
    UNION ALL SELECT doc_id, source, text, 'feed' AS via FROM documents WHERE source IN (SELECT source FROM failed)""")
def _fallback(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text", "n_chars")
    failed = docs.groupBy("source").agg(F.min("n_chars").alias("least")).where("least < 12").select("source")
    answered = docs.join(failed, "source", "left_anti").select("doc_id", "source", "text", F.lit("answer").alias("via"))
    feed = docs.select("doc_id", "source", "text", F.lit("feed").alias("via"))
    return source_fallback(answered, feed, failed, ["source"])


@query("union_sources", f"""WITH {O.DOCS}, {O.PAGES} SELECT rank, name, tool_url, source, lang FROM docs UNION ALL
    SELECT rank, name, tool_url, source, NULL AS lang FROM pgs UNION ALL
    SELECT conv_id * 1000 + turn AS rank, role AS name, NULL AS tool_url, 'conversations' AS source, NULL AS lang FROM conversations""")
def _union(spark, sf):
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rank"), F.col("role").alias("name"), F.lit("conversations").alias("source"))
    docs = _docs(spark, sf).select("rank", "name", "tool_url", "source", "lang")
    return union_sources([docs, _pages(spark, sf).drop("html"), turns])


# --- Triage: users' events are decisions on the document of the same number. ---

STATE = "CASE event_type WHEN 'purchase' THEN 'pub' WHEN 'click' THEN 'done' WHEN 'error' THEN 'ign' ELSE 'pending' END"
ITEM_URL = "'https://items.example.com/' || "
CHANGES = f"changes AS (SELECT {ITEM_URL}user_id AS tool_url, event_id AS seq, epoch_us(ts) AS ts, {STATE} AS state FROM events)"
LATEST = f"{CHANGES}, triage AS (SELECT tool_url, arg_max(state, (ts, seq)) AS state, max(ts) AS ts FROM changes GROUP BY tool_url)"
TRIAGED = f"""{O.DOCS}, {LATEST}, items AS (SELECT doc_id AS rank, name, {ITEM_URL}doc_id AS tool_url, description, source, n_chars,
      {O.pricing('description')} AS pricing, [lang, source] AS categories FROM docs),
    triaged AS (SELECT items.*, coalesce(state, 'pending') AS state FROM items LEFT JOIN triage ON triage.tool_url = items.tool_url)"""


def _changes(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "purchase", "pub").when(kind == "click", "done").when(kind == "error", "ign").otherwise("pending")
    micros = F.unix_date(F.to_date("ts")).cast("bigint") * 86_400_000_000 + F.expr("cast(extract(hour from ts) * 3600 + extract(minute from ts) * 60 as bigint) * 1000000 + cast(extract(second from ts) * 1000000 as bigint)")
    return table(spark, sf, "events").select(
        F.concat(F.lit("https://items.example.com/"), "user_id").alias("tool_url"), F.col("event_id").alias("seq"), micros.alias("ts"), state.alias("state"))


def _triage_items(spark, sf) -> DataFrame:
    docs = _docs(spark, sf)
    return docs.select(
        "rank", "name", F.concat(F.lit("https://items.example.com/"), "doc_id").alias("tool_url"), "description", "source", "n_chars",
        X.guess_pricing(F.col("description")).alias("pricing"), F.array("lang", "source").alias("categories"))


def _triaged(spark, sf) -> DataFrame:
    return T.with_triage_state(_triage_items(spark, sf), T.latest_triage_state(_changes(spark, sf)))


@query("triage_state", f"WITH {LATEST} SELECT tool_url, state, ts FROM triage")
def _state(spark, sf):
    return T.latest_triage_state(_changes(spark, sf))


@query("triage_reset", f"""WITH {CHANGES}, kept AS (SELECT * FROM changes WHERE ts > (SELECT max(epoch_us(ts)) FROM events WHERE value > 120))
    SELECT tool_url, arg_max(state, (ts, seq)) AS state, max(ts) AS ts FROM kept GROUP BY tool_url""")
def _reset(spark, sf):
    changes = _changes(spark, sf)
    resets = changes.join(table(spark, sf, "events").where("value > 120").select(F.col("event_id").alias("seq")), "seq", "left_semi")
    return T.latest_triage_state(T.reset_triage(changes, resets.select("ts")))


@query("triage_stream", SQL["triage_reset"])
def _triage_stream(spark, sf):
    """All events as a stream of changes with resets among them, later ones landed first, folded half way."""
    events = table(spark, sf, "events")
    changes = _changes(spark, sf).withColumn("reset", F.lit(False))
    resets = changes.join(events.where("value > 120").select(F.col("event_id").alias("seq")), "seq", "left_semi").select(
        F.lit(None).cast("string").alias("tool_url"), F.lit(None).cast("string").alias("state"), "ts", "seq", F.lit(True).alias("reset"))
    folder = f"{shared_folder(spark)}/triage-stream-{uuid.uuid4().hex}"
    for half in (1, 0):
        changes.unionByName(resets).where(F.pmod("seq", F.lit(2)) == half).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(TRIAGE_EVENT_SCHEMA).option("maxFilesPerTrigger", 16).parquet(f"{folder}/in")
        keep_triage(stream, f"{folder}/kept", f"{folder}/checkpoint").awaitTermination()
        if half:
            fold_triage(spark, f"{folder}/kept")
    return read_triage(spark, f"{folder}/kept")


@query("with_triage", f"WITH {TRIAGED} SELECT rank, tool_url, pricing, state FROM triaged")
def _with_triage(spark, sf):
    return _triaged(spark, sf).select("rank", "tool_url", "pricing", "state")


@query("triage_counts", f"""WITH {TRIAGED} SELECT count(*) AS total, count(*) FILTER (state = 'pub') AS pub, count(*) FILTER (state = 'done') AS done,
    count(*) FILTER (state = 'pending') AS pending, count(*) FILTER (pricing IN ('free', 'freemium')) AS free, CAST(7 AS BIGINT) AS new_today FROM triaged""")
def _counts(spark, sf):
    return T.triage_counts(_triaged(spark, sf), 7)


@query("prune_triage", f"WITH {TRIAGED} SELECT tool_url, state, ts FROM triage WHERE tool_url IN (SELECT tool_url FROM items WHERE n_chars > 500)")
def _prune(spark, sf):
    return T.prune_triage(T.latest_triage_state(_changes(spark, sf)), _triage_items(spark, sf).where("n_chars > 500"))


for _view, _where in {"all": "true", "pending": "state = 'pending'", "pub": "state = 'pub'", "done": "state = 'done'",
                      "free": "pricing IN ('free', 'freemium')"}.items():
    @query(f"view_{_view}", f"WITH {TRIAGED} SELECT rank, name, state, pricing FROM triaged WHERE {_where}")
    def _run_view(spark, sf, view=_view):
        return T.triage_view(_triaged(spark, sf), view).select("rank", "name", "state", "pricing")


def _order_sql(free: int) -> str:
    ranked = f"CASE pricing WHEN 'free' THEN {free} WHEN 'freemium' THEN 1 WHEN 'paid' THEN 3 ELSE 2 END"
    return f"""WITH {TRIAGED} SELECT rank, state, pricing, CASE WHEN state = 'pending' THEN 0 ELSE 1 END AS part,
        CASE WHEN state = 'pending' THEN {ranked} ELSE 0 END AS pricing_rank FROM triaged ORDER BY part, pricing_rank, rank"""


@query("triage_order", _order_sql(0))
def _order(spark, sf):
    return T.triage_order(_triaged(spark, sf), RANK).select("rank", "state", "pricing", "part", "pricing_rank")


@query("triage_order_parity", _order_sql(2))
def _order_parity(spark, sf):
    return T.triage_order(_triaged(spark, sf), RANK, parity=True).select("rank", "state", "pricing", "part", "pricing_rank")


@query("selection", f"WITH {TRIAGED} SELECT name, tool_url, array_to_string(categories, ' · ') AS categories FROM triaged WHERE state = 'pub'")
def _selection(spark, sf):
    return T.selection_list(_triaged(spark, sf))


@query("export", f"""WITH {TRIAGED}, picked AS (SELECT * FROM triaged WHERE state = 'pub')
    SELECT rank, CASE WHEN rank = (SELECT min(rank) FROM picked) THEN '' ELSE chr(10) || chr(10) || '────────' || chr(10) || chr(10) END
      || name || chr(10) || tool_url || chr(10) || chr(10) || CASE WHEN description = '' THEN '(sans description)' ELSE description END || chr(10) || chr(10)
      || 'Catégories : ' || array_to_string(categories, ', ') || chr(10) || 'Source : ' || source || chr(10) || 'Pricing : ' || pricing AS block FROM picked""")
def _export(spark, sf):
    return T.export_block(_triaged(spark, sf), RANK)


@query("export_descending", f"""WITH {TRIAGED}, picked AS (SELECT *, row_number() OVER (ORDER BY n_chars DESC, rank) AS place FROM triaged WHERE state = 'pub')
    SELECT n_chars, rank, CASE WHEN place = 1 THEN '' ELSE chr(10) || chr(10) || '────────' || chr(10) || chr(10) END
      || name || chr(10) || tool_url || chr(10) || chr(10) || CASE WHEN description = '' THEN '(sans description)' ELSE description END || chr(10) || chr(10)
      || 'Catégories : ' || array_to_string(categories, ', ') || chr(10) || 'Source : ' || source || chr(10) || 'Pricing : ' || pricing AS block FROM picked""")
def _export_descending(spark, sf):
    return T.export_block(_triaged(spark, sf), ["n_chars desc", *RANK])


# --- Payload scans over documents laid out as payloads ---

ENTRY = f"WITH {O.DOCS}, {O.DATED}"


def _scan_sql(fields: str, where: str = "true") -> str:
    return f"{ENTRY} SELECT source, seq, pos, {fields} FROM d WHERE {where}"


for _format in ("rss", "atom"):
    @query(f"feed_scan_{_format}", _scan_sql("title, tool_url AS link, body AS text, strftime(day, '%a, %d %b %Y') || ' 10:00:00 +0000' AS published", "pos < 20"))
    def _run_feed(spark, sf, atom=_format == "atom"):
        entries = S.feed_scan(samples.land_feed(table(spark, sf, "documents"), atom), 20)
        return entries.select("source", "seq", "pos", "title", "link", H.html_to_text(F.col("summary")).alias("text"), "published")


# what is wrong with a payload, and which of its entries are past repair
DEFECT = f"(seq + source_rank) % {samples.DEFECTS}"
LOST = f"({DEFECT} = 3 AND pos = 1 OR {DEFECT} = 4 AND pos = entries - 1)"
COUNTED = "(SELECT *, count(*) OVER (PARTITION BY source, seq) AS entries FROM d)"


def _dirty_sql(fields: str) -> str:
    return f"{ENTRY} SELECT source, seq, pos, {fields} FROM {COUNTED} WHERE NOT {LOST}"


@query("feed_scan_dirty", _dirty_sql(f"""{O.strip(f"title || CASE {DEFECT} WHEN 2 THEN ' R&D été & AT&T; a < b é' ELSE '' END")} AS title, tool_url AS link,
    '<p>' || replace(replace(replace(description, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || ' R&D &eacute; &amp;</p>' AS summary,
    strftime(day, '%a, %d %b %Y') || ' 10:00:00 +0000' AS published"""))
def _dirty_feed(spark, sf):
    """Feeds that aren't well-formed: whatever entry can be read is there."""
    entries = S.feed_scan(samples.land_dirty_feed(table(spark, sf, "documents")), None)
    return entries.select("source", "seq", "pos", "title", "link", "summary", "published")


@query("sitemap_dirty", _dirty_sql(f"'https://' || source || '.example.com/tool?id=' || doc_id || CASE {DEFECT} WHEN 2 THEN '&x=1' ELSE '' END AS loc, iso || '+00:00' AS date_iso") + f" AND {O.RECENT}")
def _dirty_sitemap(spark, sf):
    landed = samples.land_dirty_sitemap(table(spark, sf, "documents"))
    return S.sitemap_scan(landed, AS_OF).select("source", "seq", "pos", "loc", "date_iso")


@query("payload_outcomes", f"""{ENTRY}, p AS (SELECT source, source_rank, seq, count(*) AS n, count(*) FILTER (NOT {LOST}) AS good FROM {COUNTED} GROUP BY source, source_rank, seq),
    told AS (SELECT *, CASE WHEN {DEFECT} = 0 THEN 'ok' WHEN good = 0 THEN 'unreadable' WHEN {DEFECT} = 3 AND n = 1 THEN 'ok' ELSE 'mended' END AS outcome FROM p),
    answers AS (SELECT *, (seq + source_rank) % 5 = 0 AS bad FROM p)
    SELECT 'feed' AS kind, source, seq, outcome, CASE WHEN outcome = 'unreadable' THEN 0 ELSE good END AS entries FROM told
    UNION ALL SELECT 'sitemap', source, seq, outcome, CASE WHEN outcome = 'unreadable' THEN 0 ELSE good END FROM told
    UNION ALL SELECT 'posts', source, seq, CASE WHEN bad THEN 'unreadable' ELSE 'ok' END, CASE WHEN NOT bad THEN n END FROM answers""")
def _outcomes(spark, sf):
    """What became of dirty feeds, dirty sitemaps and answers some of which aren't lists of posts."""
    docs = table(spark, sf, "documents")
    posts = samples.land_posts(docs, garbled=True).where("kind = 'posts'")
    landed = samples.land_dirty_feed(docs).unionByName(samples.land_dirty_sitemap(docs)).unionByName(posts)
    return S.payload_outcomes(landed).select("kind", "source", "seq", "outcome", "entries")


@query("search_hits", _scan_sql(O.strip("'Show HN: ' || name") + " AS title, CAST(epoch(day) AS BIGINT) + 36000 AS created_at_i, CAST(doc_id AS VARCHAR) AS story_id, 'user_' || source AS author, "
                                "CASE WHEN lang <> 'fr' THEN body ELSE '' END AS text", "pos < 50"))
def _hits(spark, sf):
    landed = samples.land_hits(table(spark, sf, "documents")).where("kind = 'hits'")
    text = H.html_to_text(F.coalesce("story_text", F.lit("")))
    return S.search_hits_scan(landed, config.HITS_PER_PAGE).select("source", "seq", "pos", "title", "created_at_i", "story_id", "author", text.alias("text"))


@query("wp_posts", _scan_sql("title, tool_url AS link, iso AS date, 'Code ' || body || CASE WHEN lang = 'en' THEN ' Go' ELSE '' END AS text",
                             "pos < 20 AND (seq + source_rank) % 5 <> 0"))
def _posts(spark, sf):
    landed = samples.land_posts(table(spark, sf, "documents")).where("kind = 'posts' AND status = 'ok'")
    return S.wp_posts_scan(landed, config.POSTS_PER_PAGE).select(
        "source", "seq", "pos", H.html_to_plain(F.col("title")).alias("title"), "link", "date", H.html_to_text(F.col("content")).alias("text"))


@query("search_hits_whole", _scan_sql(O.strip("'Show HN: ' || name") + " AS title, CAST(epoch(day) AS BIGINT) + 36000 AS created_at_i, CAST(doc_id AS VARCHAR) AS story_id, 'user_' || source AS author, "
                                      "CASE WHEN lang <> 'fr' THEN body ELSE '' END AS text"))
def _hits_whole(spark, sf):
    """Every hit of every answer."""
    landed = samples.land_hits(table(spark, sf, "documents")).where("kind = 'hits'")
    text = H.html_to_text(F.coalesce("story_text", F.lit("")))
    return S.search_hits_scan(landed).select("source", "seq", "pos", "title", "created_at_i", "story_id", "author", text.alias("text"))


@query("wp_posts_whole", _scan_sql("title, tool_url AS link, iso AS date, 'Code ' || body || CASE WHEN lang = 'en' THEN ' Go' ELSE '' END AS text"))
def _posts_whole(spark, sf):
    """Every post of every answer."""
    landed = samples.land_posts(table(spark, sf, "documents"), failing=False).where("kind = 'posts'")
    return S.wp_posts_scan(landed).select(
        "source", "seq", "pos", H.html_to_plain(F.col("title")).alias("title"), "link", "date", H.html_to_text(F.col("content")).alias("text"))


@query("sitemap_scan", _scan_sql("'https://' || source || '.example.com/tool/my-tool-' || doc_id AS loc, iso || '+00:00' AS date_iso", O.RECENT))
def _sitemap(spark, sf):
    landed = samples.land_sitemap(table(spark, sf, "documents")).where("kind = 'sitemap'")
    return S.sitemap_scan(landed, AS_OF).select("source", "seq", "pos", "loc", "date_iso")


@query("embedded_payload", _scan_sql(
    "source || '-' || (doc_id // 40) AS slug, nullif(replace(name, chr(92), ''), '') AS name, replace(description, chr(92), '') AS description, tool_url AS website_url, "
    "CASE lang WHEN 'en' THEN 'free' WHEN 'fr' THEN 'freemium' WHEN 'es' THEN 'contact' END AS tier, iso || '.000Z' AS date"))
def _embedded(spark, sf):
    return S.embedded_payload_scan(samples.land_embedded(table(spark, sf, "documents")))


@query("html_rows", _scan_sql("CAST(CAST(epoch(day) AS BIGINT) + 36000 AS VARCHAR) AS release_ts, tool_url AS href, title AS name, CASE WHEN lang = 'es' THEN '' ELSE body END AS tagline"))
def _html_rows(spark, sf):
    return S.html_rows_scan(samples.land_listing(table(spark, sf, "documents")))


# --- Whole source chains, each over all documents, and the run over mixed sources ---

for _kind in O.CHAINS:
    @query(f"collect_{_kind}", O.chain_query(_kind))
    def _run_chain(spark, sf, kind=_kind):
        docs = table(spark, sf, "documents")
        landed = cut_lineage(samples.LANDERS[kind](docs))
        return _flat(collect(landed, AS_OF, samples.sources(samples.source_names(docs), kind), parity=kind not in ("posts", "newsletter")))


@query("fallback_unreadable", O.chain_query("posts"))
def _unreadable(spark, sf):
    """Answers that are no lists of posts, though marked as fetched, give way to the feeds of their sites."""
    docs = table(spark, sf, "documents")
    landed = cut_lineage(samples.land_posts(docs, garbled=True))
    return _flat(collect(landed, AS_OF, samples.sources(samples.source_names(docs), "posts"), parity=False))


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


@query("snapshot_roundtrip", f"WITH {O.DOCS} SELECT rank AS pos, {O.item('name', 'tool_url', 'description', 'source', O.lit('2024-01-02'))} FROM docs")
def _roundtrip(spark, sf):
    """A snapshot written as run 0 and read back as the latest one."""
    path = _new_folder(spark)
    _stored(_docs(spark, sf), path, 0)
    return _flat(snapshot_scan(spark, path)).drop("source_rank", "seq")


def _stored(rows: DataFrame, path: str, run_id: int) -> None:
    fields = I.item_columns(F.col("name"), F.col("tool_url"), F.col("description"), F.col("source"), F.lit("2024-01-02"), AS_OF.isoformat())
    written = write_snapshot(rows.select(*fields, F.lit(0).alias("source_rank"), F.lit(0).cast("bigint").alias("seq"), F.col("rank").alias("pos")), path, run_id)
    write_files(rows.sparkSession, path, run_id)
    keyed = dedup.with_keys(written)
    write_run_stats(I.run_stats(keyed, keyed, keyed.where("false"), AS_OF.isoformat()), path, run_id)


def _damage(spark: SparkSession, folder: str) -> None:
    """Cut one data file of a folder off."""
    one = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path").orderBy("path").first()["path"]
    path = spark._jvm.org.apache.hadoop.fs.Path(one)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(b"PAR1"))
    out.close()


@query("snapshot_corrupt", f"WITH {O.DOCS} SELECT rank AS pos, {O.item('name', 'tool_url', 'description', 'source', O.lit('2024-01-02'))} FROM docs WHERE lang IS DISTINCT FROM 'en'")
def _corrupt(spark, sf):
    """Three runs: one that is whole, one with a file cut off, one that never got its record. The first is read."""
    path, docs = _new_folder(spark), _docs(spark, sf)
    _stored(docs.where("not lang <=> 'en'"), path, 0)
    _stored(docs, path, 1)
    _damage(spark, f"{path}/items/run_id=1")
    write_snapshot(snapshot_scan(spark, path, before=1), path, 2)
    return _flat(snapshot_scan(spark, path)).drop("source_rank", "seq")


def _found(number: int) -> str:
    """Items of one batch of landed feeds, numbered in arrival order."""
    chain = O.feed().replace(" FROM d ", f" FROM d{number} ")
    return f"i{number} AS (SELECT *, row_number() OVER (ORDER BY source_rank, seq, pos) AS rank FROM ({chain}))"


def _batch(number: int, where: str) -> str:
    dated = O.DATED.replace("d AS (", f"d{number} AS (", 1).replace("FROM docs)", f"FROM docs WHERE {where})")
    return f"{dated}, {_found(number)}, {O.keyed(f't{number}', f'i{number}')}, {O.greedy(f'g{number}', f't{number}')}"


@query("increment_stream", f"""WITH RECURSIVE {O.DOCS}, {_batch(1, "lang IS DISTINCT FROM 'en'")}, {_batch(2, "lang = 'en'")},
    fr AS (SELECT i2.* EXCLUDE (rank) FROM i2 JOIN g2 ON r = rank), pv AS (SELECT i1.* EXCLUDE (rank) FROM i1 JOIN g1 ON r = rank WHERE length({O.strip('name')}) >= 3),
    merged AS (SELECT * FROM fr UNION ALL SELECT * FROM pv WHERE {O.url_key('tool_url')} NOT IN (SELECT {O.url_key('tool_url')} FROM fr)
      AND {O.name_key('name')} NOT IN (SELECT {O.name_key('name')} FROM fr))
    SELECT * FROM merged WHERE length({O.strip('name')}) >= 3""")
def _increment(spark, sf):
    """Two landings, each taken up by the stream as one run: first all but the English documents, then the English ones."""
    path = _new_folder(spark)
    docs = table(spark, sf, "documents")
    specs = samples.sources(samples.source_names(docs), "feed")
    for part in (docs.where("not lang <=> 'en'"), docs.where("lang = 'en'")):
        samples.land_feed(part).write.mode("append").parquet(f"{path}/landing")
        landing = read_landing(spark, f"{path}/landing")
        collect_increment(landing, f"{path}/snapshot", f"{path}/stream", lambda _: AS_OF, specs).awaitTermination()
    return _flat(snapshot_scan(spark, f"{path}/snapshot"))


# pages in these languages land with the issues, the others after the feed that replaces their items
EARLY = "coalesce(lang, '') IN ('de', 'es')"


def _merge_step(number: int, chain: str) -> str:
    """m<n>: the snapshot after the items of `chain` were merged into m<n-1>."""
    kept = f"length({O.strip('name')}) >= 3"
    older = "" if not number else f""" UNION ALL SELECT * FROM m{number - 1} WHERE {O.url_key('tool_url')} NOT IN (SELECT {O.url_key('tool_url')} FROM fr{number})
      AND {O.name_key('name')} NOT IN (SELECT {O.name_key('name')} FROM fr{number})"""
    return f"""i{number} AS (SELECT *, row_number() OVER (ORDER BY source_rank, seq, pos) AS rank FROM ({chain})),
    {O.keyed(f't{number}', f'i{number}')}, {O.greedy(f'g{number}', f't{number}')}, fr{number} AS (SELECT i{number}.* EXCLUDE (rank) FROM i{number} JOIN g{number} ON r = rank),
    m{number} AS (SELECT * FROM (SELECT * FROM fr{number}{older}) WHERE {kept})"""


OTHER_FEED = f"""x AS (SELECT * REPLACE ({O.strip("name || ' tool'")} AS title, 'https://feed-' || substr(tool_url, 9) AS tool_url, 'feed-' || source AS source,
    source_rank + (SELECT count(DISTINCT source) FROM docs) AS source_rank) FROM d)"""


@query("increment_stream_split", f"""WITH RECURSIVE {O.DOCS}, {O.DATED}, {OTHER_FEED}, {_merge_step(0, O.newsletter(EARLY, parity=True))},
    {_merge_step(1, O.feed(topic_filtered="false").replace(" FROM d ", " FROM x "))}, {_merge_step(2, O.newsletter(f"NOT {EARLY}", parity=True))} SELECT * FROM m2""")
def _increment_split(spark, sf):
    """Three landings: issues with some of their articles, feeds that list the same items elsewhere, and the other articles.

    Items of the first landing stay replaced, though the third one brings their issues up again.
    """
    path = _new_folder(spark)
    docs = table(spark, sf, "documents")
    names = samples.source_names(docs)
    feeds = [config.SourceSpec(f"feed-{s.name}", len(names) + s.rank, "feed", s.cap) for s in samples.sources(names, "feed")]
    specs = [*samples.sources(names, "newsletter"), *feeds]
    pages = lambda where: samples.land_newsletter(docs.where(where)).where("kind = 'page'")
    issues = samples.land_newsletter(docs).where("kind = 'feed'")
    other = docs.withColumn("source", F.concat(F.lit("feed-"), samples.named_source()))
    for part in (issues.unionByName(pages(EARLY)), samples.land_feed(other, title=F.concat("name", F.lit(" tool"))), pages(f"not {EARLY}")):
        part.write.mode("append").parquet(f"{path}/landing")
        landing = read_landing(spark, f"{path}/landing")
        collect_increment(landing, f"{path}/snapshot", f"{path}/stream", lambda _: AS_OF, specs).awaitTermination()
    return _flat(snapshot_scan(spark, f"{path}/snapshot"))


PREVIOUS = f"""{O.PAGES}, {O.keyed('tp', 'pgs')}, {O.greedy('gp', 'tp')}, pv AS (SELECT CAST(1000 AS BIGINT) AS source_rank, CAST(0 AS BIGINT) AS seq, rank AS pos,
    {O.item('name', 'tool_url', "''", 'source', O.lit('2024-01-02'))} FROM pgs JOIN gp ON r = rank)"""


@query("nightly_run", f"""WITH RECURSIVE {O.DOCS}, {O.DATED}, found AS ({O.mixed_items()}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY source_rank, seq, pos) AS rank FROM found),
    {O.keyed('t', 'numbered')}, {O.greedy('g', 't')}, {PREVIOUS},
    fr AS (SELECT numbered.* EXCLUDE (rank) FROM numbered JOIN g ON r = rank),
    merged AS (SELECT * FROM fr UNION ALL SELECT * FROM pv WHERE {O.url_key('tool_url')} NOT IN (SELECT {O.url_key('tool_url')} FROM fr)
      AND {O.name_key('name')} NOT IN (SELECT {O.name_key('name')} FROM fr))
    SELECT * FROM merged WHERE length({O.strip('name')}) >= 3""")
def _nightly(spark, sf):
    docs = table(spark, sf, "documents")
    landed = cut_lineage(samples.land_mixed(docs))
    collected = cut_lineage(collect(landed, AS_OF, samples.sources(samples.source_names(docs))))
    pages = _pages(spark, sf)
    fields = I.item_columns(F.col("name"), F.col("tool_url"), F.lit(""), F.col("source"), F.lit("2024-01-02"), AS_OF.isoformat())
    order = [F.lit(1000).alias("source_rank"), F.lit(0).cast("bigint").alias("seq"), F.col("rank").alias("pos")]
    old = dedup.greedy_dedup(dedup.with_keys(pages), RANK).select(*fields, *order)
    return _flat(merge_run(collected, dedup.with_keys(old), AS_OF).snapshot)
