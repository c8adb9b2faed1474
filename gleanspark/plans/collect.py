"""Source chains: landed payloads to item records.

Sources of one kind share one plan, with per-source settings looked up by
source, so the landed table is read once per kind and not once per source.
Chains give raw rows; the record is built once, over all of them. Join keys in
the chains lie inside one payload, so none of them can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config
from ..config import SourceSpec, default_sources
from ..functions import html as H, text as X
from ..functions.dates import as_instant, epoch_to_iso, is_recent, parse_date
from ..operators.dedup import distinct_first, distinct_links_per_article
from ..operators.items import cap_per_source, item_columns
from ..operators.joins import blocklist_anti, first_author_reply
from ..sources import payloads as S
from ..sources.combine import source_fallback, union_sources

FEED_KINDS = ["feed", "product_feed", "launch_feed", "title_feed"]
# anchors of one article are numbered below the article's place in its feed
ANCHORS_PER_ENTRY = 1_000_000


def _per_source(specs: Sequence[SourceSpec], value, type_name: str = "int") -> Column:
    """A setting of each row's source, null where the source has none."""
    settings = {s.name: value(s) for s in specs if value(s) is not None}
    return F.try_element_at(X.constant(settings, f"map<string,{type_name}>"), F.col("source"))


def _has(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


@dataclass(frozen=True)
class Run:
    """What a collection run is asked for: sources, its moment, and whether to keep every quirk."""

    landing: DataFrame
    as_of: datetime
    sources: tuple[SourceSpec, ...]
    parity: bool = True

    def specs(self, *kinds: str) -> list[SourceSpec]:
        return [s for s in self.sources if s.kind in kinds]

    def landed(self, specs: Sequence[SourceSpec], kind: str, status: str = "ok") -> DataFrame:
        names = [s.name for s in specs]
        return self.landing.where((F.col("kind") == kind) & F.col("source").isin(names) & (F.col("status") == status))

    def not_fetched(self, specs: Sequence[SourceSpec], kind: str) -> DataFrame:
        """Payloads whose fetch failed or gave something that can't be read."""
        names = [s.name for s in specs]
        return self.landing.where((F.col("kind") == kind) & F.col("source").isin(names) & S.not_fetched(kind))

    def recent(self, date_iso: str) -> Column:
        return is_recent(F.col(date_iso), self.as_of)

    def date(self, text: str) -> Column:
        return parse_date(F.col(text), self.parity)

    def external(self, url: Column) -> Column:
        return X.is_external(url, parity=self.parity)


def _raw(rows: DataFrame, name: str, url: str, description: Column, date_iso: str, pricing: Column | None = None) -> DataFrame:
    """The columns that all chains share."""
    return rows.select(
        *([S.BATCH] if S.BATCH in rows.columns else []), "source", F.col("seq").cast("bigint").alias("seq"), F.col("pos").cast("bigint").alias("pos"),
        F.col(name).alias("name"), F.col(url).alias("url"), description.alias("description"), F.col(date_iso).alias("date_iso"),
        (F.lit(None).cast("string") if pricing is None else pricing).alias("pricing"))


def _with_pages(run: Run, specs: Sequence[SourceSpec], rows: DataFrame, url: str) -> DataFrame:
    """Rows that name a page of their payload, with that page."""
    batch = [F.col(S.BATCH).alias("page_batch")] if S.BATCH in run.landing.columns else []
    pages = run.landed(specs, "page").select("source", "seq", F.col("url").alias(url), "payload", *batch)
    return S.latest_batch(rows.join(pages, [*S.PAYLOAD_KEY, url]), "page_batch")


def _capped(rows: DataFrame, specs: Sequence[SourceSpec]) -> DataFrame:
    """Each payload's first rows, as many as its source's cap."""
    return cap_per_source(rows, max(s.cap for s in specs), own_cap=_per_source(specs, lambda s: s.cap))


def feed_rows(run: Run) -> DataFrame:
    """All feeds in one pass, and the feeds of directories whose posts could not be fetched.

    Plain feeds may be filtered by topic. The product feed must be on topic and
    links to the product's own site where its text has such a link. Launch
    feeds must announce something: in title or text, or in the title alone, in
    which case they carry no description.
    """
    posts, feeds = run.specs("posts"), run.specs(*FEED_KINDS)
    payloads = run.landed(feeds, "feed")
    if posts:
        # decided per payload, so the other directories' feeds are not even parsed
        payloads = source_fallback(payloads, run.landed(posts, "feed"), run.not_fetched(posts, "posts"), hot_rows=None)
    specs = [*feeds, *posts]
    kind = _per_source(specs, lambda s: s.kind, "string")
    cap = _per_source(specs, lambda s: s.fallback_cap if s.kind == "posts" else s.cap)
    rows = S.feed_scan(payloads, cap).withColumns({"date_iso": run.date("published"), "kind": kind})
    rows = rows.where((F.col("title") != "") & run.recent("date_iso") & ~X.is_listicle(F.col("title")))
    is_kind = lambda name: F.col("kind") == name
    rows = rows.where(_has("link") | F.col("kind").isin("product_feed", "launch_feed"))
    # as the one row of a list, so that the filters below don't work the text out once more
    rows = rows.select("*", F.explode(F.array(H.html_to_text(F.col("summary")))).alias("text"))

    titled = F.concat_ws(" ", "title", "text")
    keep = F.lit(True)
    topical = [s.name for s in feeds if s.topic_filter]
    if topical:
        keep = F.when(F.col("source").isin(topical), X.topic_filter(titled)).otherwise(keep)
    if run.specs("product_feed"):
        plain = F.concat_ws(" ", "title", H.html_to_plain(F.col("summary")))
        keep = F.when(is_kind("product_feed"), X.topic_filter(plain, config.PRODUCT_TOPIC_TERMS)).otherwise(keep)
    if run.specs("launch_feed"):
        keep = F.when(is_kind("launch_feed"), X.launch_filter(titled)).otherwise(keep)
    if run.specs("title_feed"):
        keep = F.when(is_kind("title_feed"), X.launch_filter(F.col("title"), config.LAUNCH_TITLE_TERMS)).otherwise(keep)
    rows = rows.where(keep)

    url, text = F.coalesce("link", F.lit("")), F.col("text")
    if run.specs("product_feed"):
        own_site = F.coalesce(H.first_external_link(F.col("summary"), run.external, F.col("link")), F.lit(""))
        url = F.when(is_kind("product_feed"), own_site).otherwise(url)
        text = F.when(is_kind("product_feed"), X.clean_discussion_tail(text)).otherwise(text)
    if run.specs("title_feed"):
        text = F.when(is_kind("title_feed"), "").otherwise(text)
    return _raw(rows.withColumn("url", url), "title", "url", text, "date_iso")


def show_rows(run: Run) -> DataFrame:
    """Search hits that show an item; where one has no text, its author's first reply describes it."""
    specs = run.specs("hits")
    hits = S.search_hits_scan(run.landed(specs, "hits"))
    oldest = F.unix_timestamp(as_instant(run.as_of)) - config.RECENT_HOURS * 3600
    hits = hits.where((F.col("title") != "") & _has("url") & (F.coalesce("created_at_i", F.lit(0)) > oldest))
    hits = hits.where(X.show_filter(F.col("title"), F.col("url")))
    hits = distinct_first(hits, "url", ["pos"], within=S.PAYLOAD_KEY)
    hits = _capped(hits, specs).withColumns({
        "name": X.truncate_text(X.clean_show_prefix(F.col("title")), config.HIT_NAME_CHARS),
        "description": H.html_to_text(F.coalesce("story_text", F.lit(""))),
        "date_iso": epoch_to_iso(F.col("created_at_i")),
        "author": F.coalesce("author", F.lit("")),
    })
    replies = S.replies_scan(run.landed(specs, "replies"))
    hits = first_author_reply(hits, replies, H.html_to_text, hot_rows=None)
    return _raw(hits, "name", "url", F.col("description"), "date_iso")


def posts_rows(run: Run) -> DataFrame:
    """WordPress directories: the first link out of a post, described by its excerpt."""
    specs = run.specs("posts")
    posts = S.wp_posts_scan(run.landed(specs, "posts"), _per_source(specs, lambda s: s.cap)).withColumns({
        "name": H.html_to_plain(F.col("title")),
        "date_iso": run.date("date"),
    })
    posts = posts.where((F.col("name") != "") & run.recent("date_iso") & ~X.is_listicle(F.col("name")))
    posts = posts.withColumn("url", H.first_external_link(F.col("content"), run.external, F.col("link"))).where(_has("url"))
    text = X.excerpt_fallback(H.html_to_text(F.col("excerpt")), H.html_to_text(F.col("content")))
    return _raw(posts, "name", "url", text, "date_iso")


def sitemap_rows(run: Run) -> DataFrame:
    """Recently changed pages of a sitemap, described by their own properties."""
    specs = run.specs("sitemap")
    listed = S.sitemap_scan(run.landed(specs, "sitemap"), run.as_of, run.parity)
    listed = _capped(listed, specs)
    rows = S.page_meta_scan(_with_pages(run, specs, listed, "loc"), "loc")
    return _raw(rows.where(~X.is_listicle(F.col("title"))), "title", "loc", F.col("description"), "date_iso")


def embedded_rows(run: Run) -> DataFrame:
    """Tools in a page's script data; tiers and dates are looked up by slug."""
    objects = S.embedded_payload_scan(run.landed(run.specs("embedded"), "embedded"))
    # slugs repeat within a payload only, so its objects tell each other in one window
    same = Window.partitionBy(*S.PAYLOAD_KEY, "slug")
    last = lambda value: F.max_by(value, F.when(F.col(value).isNotNull(), F.col("pos"))).over(same)
    facts = {"tier": F.coalesce(last("tier"), F.lit(config.UNKNOWN_PRICING)), "date": F.coalesce(last("date"), F.lit(""))}
    rows = objects.withColumns(facts).where(F.col("name").isNotNull())
    return _raw(rows.where(run.recent("date")), "name", "website_url", F.col("description"), "date", X.map_pricing_tier(F.col("tier")))


def listing_rows(run: Run) -> DataFrame:
    """Rows of a listing page."""
    rows = S.html_rows_scan(run.landed(run.specs("listing"), "listing")).where(_has("release_ts") & _has("href"))
    rows = rows.withColumn("date_iso", epoch_to_iso(F.col("release_ts").try_cast("bigint")))
    named = X.min_length(F.col("name"), config.MIN_NAME_CHARS) & ~X.is_listicle(F.col("name"))
    return _raw(rows.where(run.recent("date_iso") & named), "name", "href", F.col("tagline"), "date_iso")


def newsletter_rows(run: Run) -> DataFrame:
    """Links of recent newsletter issues, described by the sentence around them."""
    specs = run.specs("newsletter")
    issues = S.feed_scan(run.landed(specs, "feed"), _per_source(specs, lambda s: s.cap)).withColumn("date_iso", run.date("published"))
    issues = issues.where(run.recent("date_iso") & _has("link"))
    key = S.payload_key(issues)
    issues = issues.select(*key, F.col("pos").alias("issue"), F.col("link").alias("url"), "date_iso")
    articles = _with_pages(run, specs, issues, "url")
    found = H.context_anchors(F.col("payload"), config.ARTICLE_CONTAINER_CLASS)
    links = articles.select(*key, "issue", "date_iso", F.posexplode(found).alias("place", "link"))
    links = links.select(*key, "issue", "date_iso", "link.*",
                         (F.col("issue") * ANCHORS_PER_ENTRY + F.col("place")).alias("pos"))
    links = links.where(F.col("href").startswith("http") & X.min_length(F.col("text"), config.MIN_ANCHOR_CHARS))
    links = blocklist_anti(links, match="contains" if run.parity else "suffix")
    links = distinct_links_per_article(links, [*S.PAYLOAD_KEY, "issue"])
    return _raw(links, "text", "href", X.clean_leading_label(F.col("context")), "date_iso")


# chain -> the kinds of source it serves
CHAINS = {
    feed_rows: [*FEED_KINDS, "posts"], show_rows: ["hits"], posts_rows: ["posts"], embedded_rows: ["embedded"],
    listing_rows: ["listing"], newsletter_rows: ["newsletter"], sitemap_rows: ["sitemap"],
}


def collect(landing: DataFrame, as_of: datetime, sources: Sequence[SourceSpec] | None = None, parity: bool = True) -> DataFrame:
    """All items of a run: the record fields and the arrival order (source_rank, seq, pos).

    Where payloads tell the batch they landed in, an item carries the latest batch
    among the payloads it was made of.
    """
    run = Run(landing, as_of, tuple(default_sources() if sources is None else sources), parity)
    unknown = {s.kind for s in run.sources} - {kind for kinds in CHAINS.values() for kind in kinds}
    if unknown:
        raise ValueError(f"unknown source kinds: {sorted(unknown)}")
    rows = union_sources([chain(run) for chain, kinds in CHAINS.items() if run.specs(*kinds)])
    col = F.col
    return rows.select(
        *item_columns(col("name"), col("url"), col("description"), col("source"), col("date_iso"), as_of.isoformat(), col("pricing")),
        _per_source(run.sources, lambda s: s.rank).alias("source_rank"), "seq", "pos", *([S.BATCH] if S.BATCH in rows.columns else []))
