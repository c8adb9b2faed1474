"""Landed payloads to rows.

Each scan takes payloads (source, seq, payload) and returns one row per entry
with its position `pos` in the payload. A payload is one fetched feed, page or
API answer, so its entries are few; the work is spread over payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import config
from ..functions import html as H
from ..functions.dates import is_recent, parse_date
from ..functions.text import let, strip_space
from ..schema import FEED_ENTRY, FEED_ITEM, FEED_SCHEMA, HITS_SCHEMA, POSTS_SCHEMA, REPLIES_SCHEMA, SITEMAP_ENTRY, SITEMAP_SCHEMA

PAYLOAD_KEY = ["source", "seq"]
# the run in which a payload landed; payloads and rows have it where runs take up what earlier ones left
BATCH = "batch"
XML_OPTIONS = {"mode": "PERMISSIVE"}
# the whole text, where it isn't well-formed
CORRUPT = ", _corrupt_record string"
JSON_OPTIONS = {"mode": "PERMISSIVE"}


def _first_of(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def payload_key(payloads: DataFrame) -> list[str]:
    """The columns of the payload that its rows carry."""
    return [*PAYLOAD_KEY, *([BATCH] if BATCH in payloads.columns else [])]


def latest_batch(rows: DataFrame, partner: str) -> DataFrame:
    """Rows made of two payloads carry the later batch; `partner` is the other's, null where it gave nothing."""
    return rows.withColumn(BATCH, F.greatest(BATCH, partner)).drop(partner) if partner in rows.columns else rows


def _entries(payloads: DataFrame, array: Column, cap: int | Column | None) -> DataFrame:
    if cap is not None:
        array = F.slice(array, F.lit(1), cap if isinstance(cap, Column) else F.lit(cap))
    rows = payloads.select(*payload_key(payloads), F.posexplode(array).alias("pos", "entry"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def _item(i: Column) -> Column:
    """An RSS or RDF entry. A permanent guid stands in for a missing link, and the encoded content for a missing description."""
    guid = F.when(F.coalesce(i["guid"]["_isPermaLink"], F.lit("true")) != "false", i["guid"]["_VALUE"])
    return _entry(i["title"], F.coalesce(strip_space(i["link"]), strip_space(guid)), _first_of(i["description"], i["content:encoded"]),
                  _first_of(i["pubDate"], i["dc:date"], i["updated"]))


def _atom(e: Column) -> Column:
    """An Atom entry; its link is the first one without another purpose."""
    own = F.filter(e["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return _entry(e["title"], F.coalesce(F.try_element_at(own, F.lit(1))["_href"], F.lit(None).cast("string")),
                  _first_of(e["summary"], e["content"]), _first_of(e["published"], e["updated"]))


def _entry(title: Column, link: Column, summary: Column, published: Column) -> Column:
    return F.struct(strip_space(F.coalesce(title, F.lit(""))).alias("title"), link.alias("link"),
                    F.coalesce(summary, F.lit("")).alias("summary"), published.alias("published"))


def _mended(payload: Column, tag: str, fields: str, entry) -> Column:
    """Entries of a feed or sitemap that isn't well-formed: each `tag` element is cut out, repaired and read by itself.

    An element that can't be read even so, or isn't closed, is null and costs no other.
    """
    # from one start tag to the next; one that isn't closed before then has no end
    pieces = F.slice(F.split(payload, rf"(?=<{tag}[\s>])", -1), 2, 2_000_000_000)
    end = lambda piece: F.instr(piece, f"</{tag}")
    cut = F.transform(pieces, lambda piece: F.when(end(piece) > 0, F.concat(F.substr(piece, F.lit(1), end(piece) - 1), F.lit(f"</{tag}>"))))
    # a wrapping element makes a missing entry tell from an empty one
    read = lambda e: F.from_xml(F.concat(F.lit("<r>"), H.repaired_xml(e), F.lit("</r>")), f"{tag} struct<{fields}>", XML_OPTIONS)[tag]
    return F.transform(cut, lambda e: let(read(e), lambda r: F.when(r.isNotNull(), entry(r))))


def _feed_entries(payload: Column) -> Column:
    feed = F.from_xml(payload, FEED_SCHEMA + CORRUPT, XML_OPTIONS)

    def strict(f: Column) -> Column:
        entries = F.coalesce(F.transform(f["channel"]["item"], _item), F.transform(f["item"], _item), F.transform(f["entry"], _atom))
        return F.when(f["_corrupt_record"].isNull(), entries)

    whole = let(feed, strict)
    mended = F.when(payload.contains("<entry"), _mended(payload, "entry", FEED_ENTRY, _atom)).otherwise(_mended(payload, "item", FEED_ITEM, _item))
    return F.coalesce(whole, mended)


def feed_scan(payloads: DataFrame, cap: int | Column | None = config.DEFAULT_FEED_CAP) -> DataFrame:
    """RSS, RDF and Atom feeds to title, link, summary, published; the first `cap` entries per feed.

    A feed that isn't well-formed is read entry by entry: bare ampersands,
    references and angle brackets that XML doesn't know are repaired, and an entry that
    can't be read (or that the end of a cut-off feed falls into) is the only one lost.
    """
    rows = _entries(payloads, _feed_entries(F.col("payload")), cap).where(F.col("entry").isNotNull())
    return rows.select(*payload_key(payloads), "pos", "entry.*")


def search_hits_scan(payloads: DataFrame, cap: int | Column | None = None) -> DataFrame:
    """Hits of a search API answer: all, or the first `cap` of each."""
    parsed = payloads.withColumn("answer", F.from_json("payload", HITS_SCHEMA, JSON_OPTIONS))
    return _entries(parsed, F.col("answer.hits"), cap).select(
        *payload_key(payloads), "pos", strip_space(F.coalesce("entry.title", F.lit(""))).alias("title"), "entry.url",
        "entry.created_at_i", "entry.story_text", F.col("entry.objectID").alias("story_id"), "entry.author")


def replies_scan(payloads: DataFrame) -> DataFrame:
    """Reply trees (url = story id) to story_id, seq, pos, author, text; seq tells the payloads of one story apart."""
    own = [c for c in payload_key(payloads) if c != "source"]
    tree = payloads.select(F.col("url").alias("story_id"), *own, F.from_json("payload", REPLIES_SCHEMA, JSON_OPTIONS).alias("tree"))
    return tree.select("story_id", *own, F.posexplode("tree.children").alias("pos", "reply")).select("story_id", *own, "pos", "reply.*")


def _posts(payload: Column) -> Column:
    """A list of posts; an object isn't taken for a list of one."""
    return F.when(payload.rlike(r"^\s*\["), F.from_json(payload, POSTS_SCHEMA, JSON_OPTIONS))


def wp_posts_scan(payloads: DataFrame, cap: int | Column | None = None) -> DataFrame:
    """S3: posts of a WordPress answer: title, link, content, excerpt, date; all, or the first `cap` of each."""
    parsed = payloads.withColumn("posts", _posts(F.col("payload")))
    text = lambda field: F.coalesce(F.col(f"entry.{field}.rendered"), F.lit("")).alias(field)
    return _entries(parsed, F.col("posts"), cap).select(
        *payload_key(payloads), "pos", text("title"), "entry.link", text("content"), text("excerpt"), "entry.date")


def _sitemap_entries(payload: Column) -> Column:
    whole = let(F.from_xml(payload, SITEMAP_SCHEMA + CORRUPT, XML_OPTIONS), lambda m: F.when(m["_corrupt_record"].isNull(), m["url"]))
    return F.coalesce(whole, _mended(payload, "url", SITEMAP_ENTRY, lambda e: e))


def sitemap_scan(payloads: DataFrame, as_of, parity: bool = False) -> DataFrame:
    """Sitemap entries with a readable and recent lastmod: loc, date_iso. Mended like feeds where not well-formed."""
    rows = _entries(payloads, _sitemap_entries(F.col("payload")), None).where(F.col("entry").isNotNull()).select(
        *payload_key(payloads), "pos", strip_space(F.col("entry.loc")).alias("loc"),
        parse_date(F.col("entry.lastmod"), parity).alias("date_iso"))
    return rows.where(F.col("loc").isNotNull() & F.col("date_iso").isNotNull() & is_recent(F.col("date_iso"), as_of))


def html_rows_scan(payloads: DataFrame, classes: dict[str, str] = config.LISTING_CLASSES,
                   attributes: dict[str, str] = config.LISTING_ATTRIBUTES) -> DataFrame:
    """One row per listing element: release_ts, href, name, tagline."""
    children = {out: cls for out, cls in classes.items() if out != "row"}
    rows = H.classed_rows(F.col("payload"), classes["row"], attributes, children)
    return _entries(payloads, rows, None).select(*payload_key(payloads), "pos", "entry.*")


# --- What became of a payload ---

OK, EMPTY, MENDED, UNREADABLE, FAILED = "ok", "empty", "mended", "unreadable", "failed"


def _json_shape(payload: Column) -> Column:
    """The shape of a JSON text, such as ARRAY<OBJECT<...>>; null if it isn't JSON."""
    return F.schema_of_variant(F.try_parse_json(payload))


def posts_readable(payload: Column) -> Column:
    """The text is a JSON list of objects, or an empty list or object. Anything else would have ended the fetch of posts."""
    shape = let(_json_shape(payload), lambda s: s.startswith("ARRAY<OBJECT") | s.isin("ARRAY<VOID>", "OBJECT<>"))
    # a list of nulls has the shape of an empty one
    return F.coalesce(shape, F.lit(False)) & ~F.coalesce(payload.rlike(r"^\s*\[\s*null"), F.lit(False))


def not_fetched(kind: str = "posts") -> Column:
    """The fetch failed, or gave a text that can't be read as an answer."""
    failed = F.coalesce(F.col("status"), F.lit(FAILED)) != OK
    return failed | ~posts_readable(F.col("payload")) if kind == "posts" else failed


def payload_outcomes(landing: DataFrame) -> DataFrame:
    """One row per payload: source, kind, seq, url, outcome and entries.

    `failed` was marked so or holds nothing; `unreadable` holds something else than its kind does;
    `mended` isn't well-formed but some entries could be read, each by itself;
    `empty` is well-formed without entries. Pages of any form can be read.
    """
    payload, kind = F.col("payload"), F.col("kind")
    count = lambda entries: F.array_size(F.filter(entries, lambda e: e.isNotNull()))
    none = F.lit(None).cast("string")
    broken = (F.when(kind == "feed", F.from_xml(payload, FEED_SCHEMA + CORRUPT, XML_OPTIONS)["_corrupt_record"])
              .when(kind == "sitemap", F.from_xml(payload, SITEMAP_SCHEMA + CORRUPT, XML_OPTIONS)["_corrupt_record"]).otherwise(none)).isNotNull()
    rooted = F.when(kind == "feed", payload.rlike(r"<(rss|feed|rdf:RDF)[\s>]")).when(kind == "sitemap", payload.rlike(r"<urlset[\s>]")).otherwise(True)
    entries = (F.when(kind == "feed", count(_feed_entries(payload))).when(kind == "sitemap", count(_sitemap_entries(payload)))
               .when(kind == "hits", count(F.from_json(payload, HITS_SCHEMA, JSON_OPTIONS)["hits"]))
               .when((kind == "posts") & posts_readable(payload), F.coalesce(count(_posts(payload)), F.lit(0))))
    told = landing.withColumns({"broken": broken, "entries": entries.cast("bigint"), "rooted": rooted})
    listed = F.col("kind").isin("feed", "sitemap", "hits", "posts")
    outcome = (F.when((F.coalesce("status", F.lit(FAILED)) != OK) | F.col("payload").isNull(), FAILED)
               .when(~listed, OK)
               .when(F.col("entries") > 0, F.when(F.col("broken"), MENDED).otherwise(OK))
               .when(F.col("broken") | ~F.col("rooted") | F.col("kind").isin("hits", "posts") & F.col("entries").isNull(), UNREADABLE)
               .otherwise(EMPTY))
    return told.select("source", "kind", "seq", "url", outcome.alias("outcome"), F.when(outcome != FAILED, F.col("entries")).alias("entries"))


# Values inside an escaped script string: \"key\":\"value\"; the value may hold escaped characters.
_QUOTE = r'\\"'
_ESCAPED = r'(?:\\\\\\"|\\\\/|\\/|\\\\[^"/])'
_VALUE = rf"([^\\]*+(?:{_ESCAPED}[^\\]*+)*+)"


def _field(name: str) -> str:
    return rf"{_QUOTE}{name}{_QUOTE}:{_QUOTE}{_VALUE}{_QUOTE}"


def _unescape(value: Column) -> Column:
    return F.regexp_replace(value, r'\\+(["/])', "$1")


def embedded_payload_scan(payloads: DataFrame, chunk_prefix: str = config.SCRIPT_CHUNK_PREFIX) -> DataFrame:
    """Objects in the script chunks of a page, one row per slug occurrence.

    Chunks are joined in order and cut where the next slug starts, so a tier or
    date never comes from another object. `name` is null when the object lacks
    the full tuple of slug, name, description_short and website_url.
    """
    chunk = r"(?s)<script>(" + chunk_prefix.replace(".", r"\.") + r".*?)</script>"
    script = F.array_join(F.regexp_extract_all("payload", F.lit(chunk), F.lit(1)), "")
    objects = F.slice(F.split(script, rf"(?={_QUOTE}slug{_QUOTE}:)", -1), 2, 2_000_000_000)
    rows = _entries(payloads.where(F.col("payload").isNotNull()), objects, None)
    pair = ",".join(_field(f) for f in ("slug", "name", "description_short", "website_url"))
    whole = "(?s)^" + pair
    part = lambda group: F.when(F.col("entry").rlike(whole), _unescape(F.regexp_extract("entry", whole, group)))
    later = lambda field: F.nullif(F.regexp_extract("entry", "(?s)" + _field(field), 1), F.lit(""))
    return rows.select(
        *payload_key(payloads), "pos", F.regexp_extract("entry", "(?s)^" + _field("slug"), 1).alias("slug"),
        F.nullif(part(2), F.lit("")).alias("name"), part(3).alias("description"), part(4).alias("website_url"),
        later("pricing_tier").alias("tier"), later("published_at").alias("date"))


def anchor_scan(payloads: DataFrame, container: str | None = None, context: bool = False) -> DataFrame:
    """Links of a page: href, text, and with `context` the text of the enclosing paragraph or item.

    Without a container and context the links come from patterns alone.
    """
    page = F.col("payload")
    links = H.context_anchors(page, container) if context or container else H.anchors(page)
    return _entries(payloads, links, None).select(*payload_key(payloads), "pos", "entry.*")


def slug_title(url: Column) -> Column:
    """Title made of the last part of a url."""
    slug = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def page_meta_scan(pages: DataFrame, url: str = "url", html: str = "payload") -> DataFrame:
    """Title and description from a page's og: properties; the title falls back to the url's slug."""
    return pages.withColumns({
        "title": F.coalesce(H.meta_content(F.col(html), "og:title"), slug_title(F.col(url))),
        "description": F.coalesce(H.meta_content(F.col(html), "og:description"), F.lit("")),
    }).drop(html)
