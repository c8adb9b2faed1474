"""The registered queries restated in SQL for DuckDB. Written apart from the Spark code, from the rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from .. import config
from ..functions.text import SPACE
from .samples import KINDS

W = r"[^\p{L}\p{N}_]"
AS_OF_ISO = "2024-01-31T00:00:00+00:00"
RECENT_DAY = "DATE '2024-01-24'"
TEST_CATEGORIES = {w: [w] for w in ("the", "de", "que", "der", "pour", "no", "license")}


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def any_of(low: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({low}, {lit(t)})" for t in terms) + ")"


def any_word(low: str, terms: Sequence[str]) -> str:
    words = "|".join(re.escape(t) for t in terms)
    return f"regexp_matches({low}, {lit(f'(^|{W})({words})({W}|$)')})"


def strip(text: str) -> str:
    return f"regexp_replace({text}, {lit(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def collapse(text: str) -> str:
    return strip(f"regexp_replace({text}, {lit(SPACE + '+')}, ' ', 'g')")


def listicle(title: str) -> str:
    s, gap = SPACE, r"[^\p{L}\p{N}_.\n]"
    pattern = rf"(?i)^{W}*(top{s}+)?\p{{Nd}}+({gap}|{gap}[^.\n]{{0,38}}{gap})(ai{s}+)?(tools?|prompts?)({W}|$)"
    return f"regexp_matches({title}, {lit(pattern)})"


def pricing(text: str, match=any_of) -> str:
    low = f"lower({text})"
    return (f"CASE WHEN {match(low, config.FREEMIUM_TERMS)} THEN 'freemium' "
            f"WHEN {match(low, config.FREE_TERMS)} THEN 'free' ELSE 'unknown' END")


def categories(text: str, table: Mapping[str, Sequence[str]] = config.CATEGORY_TERMS) -> str:
    cases = ", ".join(f"CASE WHEN {any_word(f'lower({text})', words)} THEN {lit(c)} END" for c, words in table.items())
    return f"array_to_string(list_slice([c FOR c IN [{cases}] IF c IS NOT NULL], 1, 3), ',')"


def norm_url(url: str) -> str:
    return f"CASE WHEN starts_with({strip(url)}, 'http') THEN {strip(url)} ELSE 'https://' || {strip(url)} END"


def url_key(url: str) -> str:
    return f"lower(regexp_replace({url}, '/+$', ''))"


def name_key(name: str) -> str:
    return f"regexp_replace(lower({name}), {lit(SPACE + '|[-_]')}, '', 'g')"


def item(name: str, url: str, description: str, source: str, date_iso: str, price: str | None = None) -> str:
    both = f"({name} || ' ' || {description})"
    return (f"{strip(f'left({name}, 100)')} AS name, {norm_url(url)} AS tool_url, {collapse(f'left({description}, 400)')} AS description, "
            f"{source} AS source, {date_iso} AS date_iso, {categories(both)} AS categories, {price or pricing(both)} AS pricing")


DOCS = r"""docs AS (SELECT doc_id AS rank, regexp_extract(text, '^[^\n.]*') AS name, dense_rank() OVER (ORDER BY source) - 1 AS source_rank,
    'https://' || source || '.example.com/' || (doc_id // 100) || CASE WHEN n_chars % 3 = 0 THEN '/' ELSE '' END AS tool_url,
    source, text AS description, lang, n_chars, doc_id FROM (SELECT * REPLACE (coalesce(source, 'none') AS source) FROM documents))"""
PAGES = r"""pgs AS (SELECT page_id AS rank, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS name, url AS tool_url,
    lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS source, html FROM pages)"""
DATED = f"""d AS (SELECT *, doc_id // 500 AS seq, DATE '2024-01-01' + CAST(n_chars % 45 AS INTEGER) AS day,
    {strip('description')} AS body, {strip('name')} AS title,
    row_number() OVER (PARTITION BY source, doc_id // 500 ORDER BY doc_id) - 1 AS pos,
    strftime(DATE '2024-01-01' + CAST(n_chars % 45 AS INTEGER), '%Y-%m-%d') || 'T10:00:00' AS iso FROM docs)"""


def greedy(name: str, source: str) -> str:
    """CTEs: `<name>_g` runs the rounds over `source` (r, u, n), `<name>` holds the kept r."""
    won = "(min(r) OVER (PARTITION BY u) = r AND min(r) OVER (PARTITION BY n) = r)"
    return f"""{name}_g(r, u, n, won) AS (
      SELECT r, u, n, {won} FROM {source}
      UNION ALL
      SELECT r, u, n, {won} FROM (
        SELECT r, u, n FROM (SELECT *, bool_or(won) OVER (PARTITION BY u) wu, bool_or(won) OVER (PARTITION BY n) wn FROM {name}_g)
        WHERE NOT wu AND NOT wn)),
    {name} AS (SELECT r FROM {name}_g WHERE won)"""


def keyed(name: str, source: str, where: str = "true") -> str:
    return f"{name} AS (SELECT rank AS r, {url_key('tool_url')} AS u, {name_key('name')} AS n FROM {source} WHERE {where})"


# --- Source chains over documents laid out as payloads. Each gives source_rank, seq, pos and the record. ---

RECENT = f"day >= {RECENT_DAY}"
UTC_ISO = "iso || '+00:00'"


def _chain(fields: str, where: str, source: str = "d") -> str:
    return f"SELECT source_rank, seq, pos, {fields} FROM {source} WHERE {where}"


def feed(where="true", cap=20, topic_filtered="source_rank % 4 = 2", date=UTC_ISO):
    topic = any_of("lower(title || ' ' || body)", config.TOPIC_TERMS)
    return _chain(item("title", "tool_url", "body", "source", date),
                  f"{where} AND pos < {cap} AND title <> '' AND {RECENT} AND NOT {listicle('title')} AND (NOT ({topic_filtered}) OR {topic})")


def product_feed(where="true"):
    url = "CASE WHEN lang = 'de' THEN tool_url ELSE 'https://tools.example.org/' || doc_id END"
    topic = any_of("lower(title || ' ' || description || 'Link Site Discussion | Link')", config.PRODUCT_TOPIC_TERMS)
    return _chain(item("title", url, "(body || ' Link Site')", "source", UTC_ISO),
                  f"{where} AND pos < 20 AND title <> '' AND {RECENT} AND NOT {listicle('title')} AND {topic}")


def launch_feed(where="true"):
    launch = any_of("lower(title || ' ' || body)", config.LAUNCH_TERMS)
    return _chain(item("title", "tool_url", "body", "source", UTC_ISO),
                  f"{where} AND pos < 20 AND title <> '' AND {RECENT} AND NOT {listicle('title')} AND {launch}")


def title_feed(where="true"):
    title = strip("(name || CASE WHEN lang IN ('fr', 'es') THEN ' library' ELSE '' END)")
    return _chain(item(title, "tool_url", "''", "source", UTC_ISO),
                  f"{where} AND pos < 20 AND {title} <> '' AND {RECENT} AND NOT {listicle(title)} "
                  f"AND {any_of(f'lower({title})', config.LAUNCH_TITLE_TERMS)}")


def hits(where="true"):
    shown = strip("'Show HN: ' || name")
    name = f"left(regexp_replace({shown}, {lit(f'(?i)^show hn{SPACE}*[:-]{SPACE}*')}, ''), 80)"
    url = "(tool_url || CASE WHEN lang = 'es' THEN '/blog/' ELSE '' END)"
    low = f"lower({shown})"
    keep = (f"{RECENT} AND NOT {any_of(f'lower({url})', config.SHOW_PATH_MARKERS)} AND {any_of(low, config.SHOW_TITLE_TERMS)} "
            f"AND NOT {any_of(low, config.SHOW_ARTICLE_PHRASES)} AND NOT {listicle(shown)}")
    one = f"SELECT *, {url} AS u, row_number() OVER (PARTITION BY source, seq, {url} ORDER BY pos) AS k FROM d WHERE {where} AND {keep}"
    capped = f"(SELECT *, row_number() OVER (PARTITION BY source, seq ORDER BY pos) AS m FROM ({one}) WHERE k = 1)"
    return _chain(item(name, "u", "body", "source", UTC_ISO), "m <= 20", capped)


def posts(where="true", parity=False):
    failed = "(seq + source_rank) % 5 = 0"
    content = "('Code ' || body || CASE WHEN lang = 'en' THEN ' Go' ELSE '' END)"
    text = f"CASE WHEN lang = 'fr' THEN title ELSE left({content}, 300) END"
    url = "CASE WHEN lang = 'en' THEN 'https://tools.example.org/' || doc_id ELSE tool_url END"
    recent, date = ("true", lit(AS_OF_ISO)) if parity else (RECENT, "iso")
    primary = _chain(item("title", url, f"({text})", "source", date),
                     f"{where} AND NOT ({failed}) AND pos < 20 AND title <> '' AND {recent} AND NOT {listicle('title')}")
    return f"{primary} UNION ALL {feed(f'{where} AND {failed}', 15, 'false')}"


def embedded(where="true"):
    slug = "(doc_id // 40)"
    tier = "CASE lang WHEN 'en' THEN 'free' WHEN 'fr' THEN 'freemium' WHEN 'es' THEN 'contact' END"
    facts = (f"(SELECT *, arg_max({tier}, pos) OVER w AS last_tier, arg_max(day, pos) OVER w AS last_day FROM d "
             f"WHERE {where} WINDOW w AS (PARTITION BY source, seq, {slug}))")
    price = "CASE WHEN last_tier IN ('free', 'freemium', 'paid') THEN last_tier ELSE 'unknown' END"
    date = "strftime(last_day, '%Y-%m-%d') || 'T10:00:00.000Z'"
    clean = lambda c: f"replace({c}, chr(92), '')"
    return _chain(item(clean("name"), "tool_url", clean("description"), "source", date, price),
                  f"{clean('name')} <> '' AND last_day >= {RECENT_DAY}", facts)


def listing(where="true"):
    tagline = "CASE WHEN lang = 'es' THEN '' ELSE body END"
    return _chain(item("title", "tool_url", f"({tagline})", "source", UTC_ISO),
                  f"{where} AND {RECENT} AND length(title) >= 3 AND NOT {listicle('title')}")


def newsletter(where="true", parity=False):
    keep = f"{where} AND pos < 5 AND {RECENT}"
    text = strip("title || ' tool'")
    tool = f"SELECT source_rank, seq, pos * 1000000 + 1 AS pos, {item(text, 'tool_url', f'(body || chr(32) || {text})', 'source', UTC_ISO)} FROM d WHERE {keep}"
    # the link outside the container is not numbered, so the tool is the container's first link
    tool = tool.replace("pos * 1000000 + 1", "pos * 1000000")
    maker = _chain(item("'at the maker'", "('https://www.microsoft.com/' || doc_id)", "'Read at the maker'", "source", UTC_ISO), keep)
    maker = maker.replace("SELECT source_rank, seq, pos,", "SELECT source_rank, seq, pos * 1000000 + 3 AS pos,", 1)
    return tool if parity else f"{tool} UNION ALL {maker}"


def sitemap(where="true"):
    slug = "('My Tool ' || doc_id)"
    title = f"CASE WHEN lang = 'de' OR title = '' THEN {slug} ELSE title END"
    text = "CASE WHEN lang IN ('fr', 'es') THEN body ELSE '' END"
    url = "('https://' || source || '.example.com/tool/my-tool-' || doc_id)"
    capped = f"(SELECT *, row_number() OVER (PARTITION BY source, seq ORDER BY pos) AS k FROM d WHERE {where} AND {RECENT})"
    return _chain(item(f"({title})", url, f"({text})", "source", UTC_ISO), f"k <= 20 AND NOT {listicle(f'({title})')}", capped)


CHAINS = {
    "product_feed": product_feed, "hits": hits, "posts": posts, "embedded": embedded, "listing": listing,
    "newsletter": newsletter, "feed": feed, "launch_feed": launch_feed, "title_feed": title_feed, "sitemap": sitemap,
}


def chain_query(kind: str) -> str:
    return f"WITH {DOCS}, {DATED} {CHAINS[kind]()}"


def mixed_items() -> str:
    """All sources as their kinds, with every quirk kept."""
    parts = []
    for kind, chain in CHAINS.items():
        where = f"source_rank % {len(KINDS)} = {KINDS.index(kind)}"
        parts.append(chain(where, parity=True) if kind in ("posts", "newsletter") else chain(where))
    return " UNION ALL ".join(parts)
