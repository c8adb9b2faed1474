"""Column functions on names, urls and plain text. All stay on the JVM side."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .. import config
from ..config import UNKNOWN_PRICING

# White space, and letters, digits and underscore, as Unicode sets. Spelled out so that
# patterns mean the same on every Java version.
SPACE_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE_CHARS = "".join(map(chr, SPACE_CODES))
SPACE = "[" + "".join(rf"\x{{{code:X}}}" for code in SPACE_CODES) + "]"
WORD = r"\p{L}\p{N}_"
WORD_START = rf"(?<![{WORD}])"
WORD_END = rf"(?![{WORD}])"


def quoted(terms: Sequence[str]) -> str:
    """Regular expression alternation of literal terms, longest first."""
    return "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))


def shortest_terms(terms: Sequence[str]) -> list[str]:
    """Terms without those that contain another one: for a substring test they add nothing."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def constant(value: object, schema: str) -> Column:
    """A nested literal. It is folded when the plan is optimized."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def truncate_text(text: Column, chars: int) -> Column:
    """The first `chars` characters."""
    return F.substring(text, 1, chars)


def collapse_whitespace(text: Column) -> Column:
    """C4: every run of white space becomes one space; the ends are trimmed."""
    return strip_space(F.regexp_replace(text, SPACE + "+", " "))


def clean_discussion_tail(text: Column) -> Column:
    """Drop the "Discussion | Link" text."""
    return strip_space(F.regexp_replace(text, rf"Discussion{SPACE}*\|{SPACE}*Link", ""))


def clean_show_prefix(title: Column) -> Column:
    """Drop a leading "Show HN:" in any case."""
    return F.regexp_replace(title, rf"(?iu)^show hn{SPACE}*[:\-–]{SPACE}*", "")


def clean_leading_label(text: Column) -> Column:
    """Drop a short leading label that ends in a colon."""
    return F.regexp_replace(text, rf"^[^{WORD}]*[A-Za-z][{WORD}' ]{{0,30}}:{SPACE}*", "")


def norm_url(url: Column) -> Column:
    """Trimmed, and with a scheme."""
    trimmed = strip_space(url)
    return F.when(trimmed.startswith("http"), trimmed).otherwise(F.concat(F.lit("https://"), trimmed))


def url_key(url: Column) -> Column:
    """Lower-cased url without trailing slashes."""
    return F.lower(F.rtrim(url, F.lit("/")))


def name_key(name: Column) -> Column:
    """Lower-cased name without spaces, hyphens and underscores."""
    return F.regexp_replace(F.lower(name), SPACE + r"|[\-_]", "")


def url_host(url: Column) -> Column:
    """Lower-cased host part, empty when the url has no scheme."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def contains_any(text: Column, terms: Sequence[str], whole_word: bool = False) -> Column:
    """Whether any term occurs in `text`; both are compared as they are, so lower-case them first."""
    if whole_word:
        return text.rlike(f"{WORD_START}(?:{quoted(terms)}){WORD_END}")
    # byte search: about three times as fast as an alternation in a regular expression
    return let(text, lambda t: reduce(or_, [t.contains(term) for term in shortest_terms(terms)]))


def min_length(text: Column, chars: int) -> Column:
    """At least `chars` characters after trimming."""
    return F.length(strip_space(text)) >= chars


def guess_pricing(
    text: Column,
    free: Sequence[str] = config.FREE_TERMS,
    freemium: Sequence[str] = config.FREEMIUM_TERMS,
    whole_word: bool = False,
) -> Column:
    """Freemium, free or unknown, by words in the text; freemium wins."""
    def guess(low: Column) -> Column:
        return (
            F.when(contains_any(low, freemium, whole_word), "freemium")
            .when(contains_any(low, free, whole_word), "free")
            .otherwise(UNKNOWN_PRICING)
        )

    return let(F.lower(F.coalesce(text, F.lit(""))), guess)


def map_pricing_tier(tier: Column) -> Column:
    """A known tier passes, anything else is unknown."""
    return F.when(tier.isin(config.PRICING_TIERS), tier).otherwise(UNKNOWN_PRICING)


LISTICLE = (
    rf"(?iu)^[^{WORD}]*(?:top{SPACE}+)?\p{{Nd}}+{WORD_END}[^.\n]{{0,40}}"
    rf"{WORD_START}(?:ai{SPACE}+)?(?:tools?|prompts?){WORD_END}"
)


def is_listicle(title: Column) -> Column:
    """Title of a "top N tools" kind of article. Null is false."""
    return F.coalesce(title.rlike(LISTICLE), F.lit(False))


def _fold(text: Column) -> Column:
    """Lower case, with the letters that any-case matching treats as i and s."""
    plain = F.when(text.rlike("[İıſ]"), F.translate(text, "İıſ", "iis")).otherwise(text)
    return F.lower(plain)


def _term_pattern(terms: Sequence[str]) -> str:
    """Zero-width pattern whose group 1 is the longest term that starts at a word start.

    Grouping by first letter and a look at the next letter keep the work per
    word small, so the text is read once however many terms there are.
    """
    by_letter: dict[str, list[str]] = {}
    for term in terms:
        if not re.match(r"\w(.*\w)?$", term):
            raise ValueError(f"a whole-word term must start and end with a letter or digit: {term!r}")
        by_letter.setdefault(term[0], []).append(term[1:])
    branches = [f"{re.escape(letter)}(?:{quoted(rest)})" for letter, rest in sorted(by_letter.items())]
    first = "".join(re.escape(letter) for letter in sorted(by_letter))
    return f"(?=[{first}]){WORD_START}(?=((?:{'|'.join(branches)}){WORD_END}))"


def guess_categories(
    text: Column,
    terms: Mapping[str, Sequence[str]] = config.CATEGORY_TERMS,
    limit: int = config.MAX_CATEGORIES,
) -> Column:
    """Categories with a whole-word hit, in declaration order, at most `limit`.

    One pass finds the longest term at each word start. Every other term that
    holds there is a prefix of it, so the longest one tells all categories.
    """
    table = {category: {t.lower() for t in words} for category, words in terms.items()}
    every = sorted(set().union(*table.values()))

    def implied_by(words: set[str]) -> list[str]:
        return [t for t in every if any(t.startswith(w) and re.match(r"\W|$", t[len(w):]) for w in words)]

    rows = constant(
        [{"category": category, "words": implied_by(words)} for category, words in table.items()],
        "array<struct<category: string, words: array<string>>>")
    found = F.array_distinct(F.regexp_extract_all(_fold(F.coalesce(text, F.lit(""))), F.lit(_term_pattern(every)), F.lit(1)))
    return let(found, lambda f: F.slice(
        F.transform(F.filter(rows, lambda r: F.arrays_overlap(r["words"], f)), lambda r: r["category"]), 1, limit))


def topic_filter(text: Column, terms: Sequence[str] = config.TOPIC_TERMS, whole_word: bool = False) -> Column:
    """Whether the text mentions the topic."""
    return contains_any(F.lower(text), terms, whole_word)


def launch_filter(text: Column, terms: Sequence[str] = config.LAUNCH_TERMS, whole_word: bool = False) -> Column:
    """Whether the text announces something."""
    return contains_any(F.lower(text), terms, whole_word)


def show_filter(
    title: Column,
    url: Column,
    title_terms: Sequence[str] = config.SHOW_TITLE_TERMS,
    article_phrases: Sequence[str] = config.SHOW_ARTICLE_PHRASES,
    path_markers: Sequence[str] = config.SHOW_PATH_MARKERS,
    own_host: str = config.SHOW_OWN_HOST,
    whole_word: bool = False,
) -> Column:
    """P10: a post that shows an item, not an article about one."""
    low = F.lower(title)
    return (
        ~url.contains(own_host)
        & ~contains_any(F.lower(url), path_markers)
        & contains_any(low, title_terms, whole_word)
        & ~contains_any(low, article_phrases)
        & ~is_listicle(title)
    )


def excerpt_fallback(excerpt: Column, content: Column, chars: int = config.EXCERPT_CHARS) -> Column:
    """The excerpt, or the start of the content when the excerpt is blank."""
    return F.when(strip_space(excerpt) != "", excerpt).otherwise(truncate_text(content, chars))


def host_matches(host: Column, domains: Sequence[str], match: str = "contains") -> Column:
    """Whether a host contains one of the domains, or (match="suffix") is one or lies under one."""
    if match == "contains":
        return host.rlike(quoted(shortest_terms(domains)))
    if match == "suffix":
        return host.rlike(rf"(^|\.)(?:{quoted(domains)})(:\d+)?$")
    raise ValueError(f"match must be 'contains' or 'suffix', not {match!r}")


def is_external(
    url: Column,
    domains: Sequence[str] = config.DIRECTORY_DOMAINS,
    parity: bool = False,
    match: str = "contains",
) -> Column:
    """An http url whose host is not on the blocklist. Null is false.

    `parity` strips every leading "w" and "." from the host, so that a blocked
    host like www.wikiaitools.com passes, as it does in the original job.
    """
    host = F.regexp_replace(url_host(url), r"^[w.]+" if parity else r"^www\.", "")
    return F.coalesce(url.startswith("http") & ~host_matches(host, domains, match), F.lit(False))
