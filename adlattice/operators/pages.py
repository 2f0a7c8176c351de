"""Operators over raw pages: result cards, links, gating and markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.html import (
    all_matches, attribute, element, first_match, has_attribute, has_classes, open_tag, sql, visible_text,
)
from adlattice.functions.scalars import (
    absolute_url, as_column, digits_int, keyword_in_context, next_page_url, non_empty, strip, url_tail_id,
)

# Markup of a result page (fixed values).
CARD = element("article", has_classes("relative", "isolate", "sf-search-ad"))
CARD_LINK = open_tag("a", has_classes("sf-search-ad-link"))
CARD_PRICE = element("span", has_classes("t3", "font-bold", "inline-block"))
CARD_SPECS = element("span", has_classes("text-caption", "font-bold", "inline-block"))
CARD_ID_PREFIX = "search-ad-"
NEXT_LINK = open_tag("a", has_attribute("rel", "next"))

# Words that hint at a consent page, and blocks a full item page has (fixed values).
CONSENT_HINTS = ["consent", "samtykke", "privacy", "cookie"]
KEY_BLOCKS = ["mobility-item-page-root", "application/ld+json"]

# Markers counted on item pages: name and pattern.
MARKERS = {
    "#mobility-item-page-root": open_tag("[a-z][a-z0-9]*", has_attribute("id", "mobility-item-page-root")),
    "#advertising-initial-state": open_tag("[a-z][a-z0-9]*", has_attribute("id", "advertising-initial-state")),
    "#contact-button-data": open_tag("[a-z][a-z0-9]*", has_attribute("id", "contact-button-data")),
    'script[type="application/ld+json"]': open_tag("script", has_attribute("type", r"application/ld\+json")),
    "dl dt": open_tag("dt"),
    "p.s-text-subtle": open_tag("p", has_classes("s-text-subtle")),
}


def result_cards(pages: DataFrame, base_url: str, scraped_at: Column, keep: list[str] = ("page_id",)) -> DataFrame:
    """One row per listing card of every result page: id, absolute link, price, specs text.

    A card without a link, id or price still gives a row with NULLs there.
    """
    cards = pages.select(*keep, F.posexplode(sql(all_matches("html", CARD))).alias("card", "__card"))
    link = cards.select(*keep, "card", "__card", sql(first_match("__card", CARD_LINK)).alias("__link"))
    return link.select(
        *keep,
        "card",
        non_empty(F.replace(sql(attribute("__link", "id")), F.lit(CARD_ID_PREFIX), F.lit(""))).alias("ad_id"),
        absolute_url(sql(attribute("__link", "href")), base_url).alias("ad_url"),
        digits_int(sql(visible_text(first_match("__card", CARD_PRICE, 1), ""))).alias("price"),
        F.coalesce(sql(visible_text(first_match("__card", CARD_SPECS, 1))), F.lit("")).alias("specs_text"),
        scraped_at.alias("scraped_at"),
    )


def next_pages(pages: DataFrame) -> DataFrame:
    """Link to the following result page of every page that has a usable one."""
    href = sql(attribute(first_match("html", NEXT_LINK), "href"))
    return pages.select("page_id", next_page_url(href, "url").alias("next_url")).where(F.col("next_url").isNotNull())


def page_fields(pages: DataFrame, base_url: str) -> DataFrame:
    """Title, first heading, id in the address, and first link of every page."""
    first_link = first_match("html", open_tag("a", r"(?=[^>]*\shref\s*=)"))
    return pages.select(
        "page_id",
        non_empty(sql(visible_text(first_match("html", element("title"), 1), ""))).alias("title"),
        non_empty(sql(visible_text(first_match("html", element("h1"), 1), ""))).alias("heading"),
        url_tail_id("url").alias("ad_id"),
        absolute_url(sql(attribute(first_link, "href")), base_url).alias("first_link"),
    )


def looks_gated(html: Column | str) -> Column:
    """A consent page, or a page without any of the key blocks."""
    lowered = F.lower(as_column(html))
    consent, blocks = F.lit(False), F.lit(False)
    for word in CONSENT_HINTS:
        consent = consent | lowered.contains(word)
    for block in KEY_BLOCKS:
        blocks = blocks | lowered.contains(block)
    return consent | ~blocks


def page_gate(pages: DataFrame, min_chars: int = 1000) -> DataFrame:
    """Validity flags of every page: too short, no markup, no item block, gated."""
    return pages.select(
        "page_id",
        (F.length("html") < min_chars).alias("too_short"),
        (~strip("html").startswith("<")).alias("no_markup"),
        (~F.contains(F.col("html"), F.lit(KEY_BLOCKS[0]))).alias("no_item_block"),
        looks_gated("html").alias("gated"),
    )


def marker_counts(pages: DataFrame, markers: dict[str, str] = MARKERS) -> DataFrame:
    """Matches of every marker on every page, zero included; all markers in one pass over a page."""
    counts = F.array(*[
        F.struct(F.lit(name).alias("marker"), F.regexp_count("html", F.lit(pattern)).alias("hits"))
        for name, pattern in markers.items()
    ])
    return pages.select("page_id", F.inline(counts))


def keyword_contexts(pages: DataFrame, keywords: list[str], around: int = 160) -> DataFrame:
    """First hit of every keyword on every page with its surroundings; pages without a hit are left out."""
    found = F.array(*[
        F.struct(F.lit(k).alias("keyword"), keyword_in_context("html", F.lit(k), around).alias("context"))
        for k in keywords
        if k.strip()
    ])
    return pages.select("page_id", F.inline(found)).where(F.col("context").isNotNull())
