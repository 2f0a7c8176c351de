"""Registered queries: raw pages, result cards and item pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.functions.html import open_tag, element
from adlattice.functions.scalars import (
    MONTHS, digits_int, localised_date, next_page_url, parsed_timestamp, url_tail_id, url_unquoted,
)
from adlattice.operators import items, pages as page_ops
from adlattice.operators.item_json import tolerant_json
from adlattice.operators.quality import informative_rows
from adlattice.plans.rendered import SITE, conflicting_pages, item_pages, result_pages
from adlattice.plans.standins import pages
from adlattice.sources.tables import read_table

PAGE_MARKERS = {
    "p": open_tag("p"),
    "li": open_tag("li"),
    "a": open_tag("a"),
    "article": element("article"),
    "main": open_tag("main"),
}
KEYWORDS = ["UND", "tion", "track(1", "qué"]


def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.page_fields(pages(spark, sf), SITE)


def page_gate(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.page_gate(pages(spark, sf), 2000)


def marker_counts(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.marker_counts(pages(spark, sf), PAGE_MARKERS)


def keyword_contexts(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.keyword_contexts(pages(spark, sf), KEYWORDS, 20)


def page_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Every page address with the number in it, its id, and three link forms resolved against it."""
    return read_table(spark, sf, "pages").select(
        "page_id",
        digits_int("url").alias("number"),
        url_tail_id("url").alias("ad_id"),
        next_page_url(F.lit("?page=2"), "url").alias("query_link"),
        next_page_url(F.lit("/next"), "url").alias("path_link"),
        next_page_url(F.lit("next"), "url").alias("bare_link"),
    )


def price_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals written as price texts and read back."""
    orders = read_table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "O", F.lit("Pris på forespørsel")).otherwise(
        F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(" kr"))
    )
    return orders.select("o_orderkey", digits_int(text).alias("price"))


def date_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in three notations and parsed back."""
    events = read_table(spark, sf, "events")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month("ts"))
    local = F.concat(F.dayofmonth("ts").cast("string"), F.lit(". "), month, F.lit(" "), F.year("ts").cast("string"),
                     F.when(F.col("event_type") != "view", F.concat(F.lit(", "), F.date_format("ts", "HH:mm"))).otherwise(""))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_type") == "click", "Z").otherwise(""))
    epoch = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return events.select(
        "event_id",
        shown(localised_date(local)).alias("from_local"),
        shown(parsed_timestamp(iso)).alias("from_iso"),
        shown(parsed_timestamp(epoch)).alias("from_epoch"),
        shown(localised_date(F.col("props"))).alias("from_garbage"),
    )


def decoded_props(spark: SparkSession, sf: str) -> DataFrame:
    """Event props read as JSON: raw, percent-encoded once, or twice, by event type."""
    once = F.url_encode("props")
    spaced = lambda c: F.replace(c, F.lit("+"), F.lit("%20"))
    text = F.when(F.col("event_type") == "view", spaced(once)).when(
        F.col("event_type") == "click", spaced(F.url_encode(spaced(once)))
    ).otherwise(F.col("props"))
    parsed = read_table(spark, sf, "events").select("event_id", tolerant_json(text).alias("v"), url_unquoted(text).alias("decoded"))
    return parsed.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), (F.length("decoded") > 0).alias("has_text"))


def result_cards(spark: SparkSession, sf: str) -> DataFrame:
    cards = page_ops.result_cards(result_pages(spark, sf), SITE, F.lit("2025-01-01").cast("timestamp_ntz"))
    return cards.select("page_id", F.col("ad_id").cast("bigint").alias("ad_id"), "ad_url", "price", "specs_text", "scraped_at")


def next_pages(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.next_pages(result_pages(spark, sf))


ITEM_COLUMNS = ["page_id", "ad_id", "title", "make", "model", "seats", "price", "currency", "material", "postal_code", "municipality"]


def item_details(spark: SparkSession, sf: str) -> DataFrame:
    parsed = items.parse_items(item_pages(spark, sf), F.lit("2025-01-01").cast("timestamp"))
    return parsed.select(*ITEM_COLUMNS, F.array_join("equipment", "|").alias("equipment"))


# What is shown of the raw extracts of a page whose sources contradict each other.
SAID_FIELDS = """data_props struct<title: string>, jsonld struct<title: string, currency: string>, contact struct<title: string>,
    dom struct<title: string, postal_code: string>, advertising struct<county: string>"""


def item_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of pages whose sources contradict each other, and what each source said of the title and a few more."""
    parsed = items.parse_items(conflicting_pages(spark, sf), F.lit("2025-01-01").cast("timestamp"))
    shown = [c for c in parsed.columns if c not in ("url", "source_json", "equipment", "images", "last_edited_at", "scraped_at")]
    # Read in one pass, not once per field.
    parsed = parsed.withColumn("said", F.from_json("source_json", SAID_FIELDS))
    said = lambda path: F.col(f"said.{path}")
    return parsed.select(
        *shown,
        F.array_join("equipment", "|").alias("equipment"),
        F.array_join("images", "|").alias("images"),
        F.date_format("last_edited_at", "yyyy-MM-dd HH:mm:ss").alias("last_edited_at"),
        said("data_props.title").alias("props_title"), said("jsonld.title").alias("linked_title"), said("dom.title").alias("visible_title"),
        said("contact.title").alias("contact_title"), said("advertising.county").alias("advertised_county"),
        said("dom.postal_code").alias("visible_code"), said("jsonld.currency").alias("linked_currency"),
    )


def article_details(spark: SparkSession, sf: str) -> DataFrame:
    """The given article pages through the item parser: only title and id can be found there."""
    parsed = items.parse_items(pages(spark, sf), F.lit("2025-01-01").cast("timestamp"))
    return informative_rows(parsed).select("page_id", "title", "ad_id", "price", "year")


QUERIES = {
    f.__name__: f
    for f in [
        page_fields, page_gate, marker_counts, keyword_contexts, page_urls, price_texts, date_texts, decoded_props,
        result_cards, next_pages, item_details, item_conflicts, article_details,
    ]
}



def _first(**values: str) -> str:
    """SQL for the first present source's value: p props, l linked data, d visible, c contact, a advertising."""
    return f"coalesce({', '.join(f'CASE WHEN {source} THEN {value} END' for source, value in values.items())}, NULL)"


_CONFLICT_FIELDS = {
    "title": _first(p="CASE WHEN f THEN n || ' props' END", l="n || ' linked'", d="n || ' visible'", c="n || ' contact'"),
    "year": _first(p="s + 1900", d="CASE WHEN f THEN s + 1850 ELSE s + 1800 END", a="s + 1700"),
    "make": _first(p="CASE WHEN f THEN b || ' props' END", l="b || ' linked'", d="b || ' spec'", a="'boat_make ' || s"),
    "model": _first(p="t || ' props'", l="t || ' linked'", d="t || ' spec'", a="'boat_model ' || s"),
    "engine_make": _first(p="b || ' motor'", d="'Spec & Co'", a="'engine_make ' || s"),
    "engine_type": _first(p="t || ' motor'", d="CASE WHEN f THEN 'Innenbords' ELSE 'grid motor' END", a="'engine_type ' || s"),
    "engine_effect_hp": _first(p="s", d="s + 10", a="s + 1704"),
    "width_cm": _first(p="s + 100", d="s + 300", a="s + 1701"),
    "depth_cm": _first(p="s + 50", d="s + 80", a="s + 1702"),
    "sleepers": _first(p="s", d="s + 5", a="s + 1703"),
    "seats": _first(p="s + 1", d="s + 6"),
    "weight_kg": _first(p="s + 1000"),
    "material": _first(p="'Tre'", d="'Glassfiber'", a="'material ' || s"),
    "boat_max_speed_knots": _first(p="s + 2", d="s + 7", a="s + 1705"),
    "registration_number": _first(p="'P' || k", d="'D' || k", a="'registration_number ' || s"),
    "lat": _first(p="s * 0.5 + 50", d="s * 0.5 + 60"),
    "lng": _first(p="s * 0.25", d="s * 0.25 + 5"),
    "postal_code": _first(p="CAST(s + 2000 AS VARCHAR)", l="CAST(s + 3000 AS VARCHAR)", d="CAST(s + 4000 AS VARCHAR)"),
    "municipality": _first(p="'Vik'", l="'Lier'", d="'Kristiansand S'", a="'municipality ' || s"),
    "county": _first(p="'Agder'", l="'Viken'", a="'county ' || s"),
    "description": "coalesce(CASE WHEN p AND f THEN n || ' as the props describe it' END, CASE WHEN d THEN n || "
                   "' is described in the visible page, in more than fifty characters' ELSE 'Meta text of ' || n || ' in short' END)",
    "price": _first(p="m", l="m + 1", d="m + 2"),
    "currency": _first(p="'EUR'", l="'SEK'", d="'NOK'"),
    "ad_id": "CAST(CASE WHEN d THEN k + 500000 WHEN c THEN k + 1000000 WHEN k % 3 = 1 THEN k + 7000000 WHEN k % 3 = 2 THEN k + 8000000 "
             "ELSE k END AS VARCHAR)",
    "length_text": _first(d="s || ' fot'"),
    "length_ft": _first(d="s + 20"),
    "fuel_type": _first(d="'Diesel'"),
    "boat_type": _first(d="t || ' boat'"),
    "color": _first(d="'Hvit'"),
    "country_name": _first(d="'Norge'"),
    "equipment": "CASE WHEN p THEN b || '|' || t WHEN d THEN 'GPS|' || b ELSE '' END",
    "images": _first(p="'a.jpg|b.jpg'"),
    "last_edited_at": _first(p="'2024-05-01 10:00:00'", d="'2025-08-10 21:23:00'"),
    "props_title": _first(p="CASE WHEN f THEN n || ' props' END"),
    "linked_title": _first(l="n || ' linked'"),
    "visible_title": _first(d="n || ' visible'"),
    "contact_title": _first(c="n || ' contact'"),
    "advertised_county": _first(a="'county ' || s"),
    "visible_code": _first(d="CAST(s + 4000 AS VARCHAR)"),
    "linked_currency": _first(l="'SEK'"),
}

_TEXT = (r"replace(replace(replace(replace(trim(regexp_extract(html, '(?s)<{t}>(.*?)</{t}>', 1)), "
         r"'&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')").replace('\\"', '"')
_COUNT = "len(regexp_extract_all(html, '{p}'))"
_ORIGIN = r"regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"

ORACLE = {
    "page_fields": rf"""SELECT page_id, nullif({_TEXT.format(t='title')}, '') AS title, nullif({_TEXT.format(t='h1')}, '') AS heading,
        nullif(regexp_extract(url, '/([0-9]+)/*$', 1), '') AS ad_id,
        '{SITE}' || nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') AS first_link FROM pages""",
    "page_gate": """SELECT page_id, length(html) < 2000 AS too_short, NOT starts_with(trim(html), '<') AS no_markup,
        NOT contains(html, 'mobility-item-page-root') AS no_item_block,
        contains(lower(html), 'consent') OR contains(lower(html), 'samtykke') OR contains(lower(html), 'privacy')
        OR contains(lower(html), 'cookie') OR NOT (contains(lower(html), 'mobility-item-page-root')
          OR contains(lower(html), 'application/ld+json')) AS gated FROM pages""",
    "marker_counts": " UNION ALL ".join(
        f"SELECT page_id, '{m}' AS marker, CAST({_COUNT.format(p=p)} AS INTEGER) AS hits FROM pages"
        for m, p in {"p": r"<p\b[^>]*>", "li": r"<li\b[^>]*>", "a": r"<a\b[^>]*>", "article": "</article>", "main": r"<main\b"}.items()
    ),
    "keyword_contexts": " UNION ALL ".join(
        f"""SELECT page_id, '{k}' AS keyword, substr(html, greatest(1, hit - 20), hit + {len(k)} + 20 - greatest(1, hit - 20)) AS context
        FROM (SELECT *, position('{k.lower()}' IN lower(html)) AS hit FROM pages) WHERE hit > 0""" for k in KEYWORDS
    ),
    "page_urls": rf"""SELECT page_id, TRY_CAST(nullif(regexp_replace(url, '[^0-9]', '', 'g'), '') AS INTEGER) AS number,
        nullif(regexp_extract(url, '/([0-9]+)/*$', 1), '') AS ad_id,
        {_ORIGIN} || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) || '?page=2' AS query_link,
        {_ORIGIN} || '/next' AS path_link, CAST(NULL AS VARCHAR) AS bare_link FROM pages""",
    "price_texts": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_totalprice) AS INTEGER) END AS price FROM orders""",
    "date_texts": """SELECT event_id,
        strftime(CASE WHEN event_type = 'view' THEN date_trunc('day', ts) ELSE date_trunc('minute', ts) END, '%Y-%m-%d %H:%M:%S') AS from_local,
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_iso,
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_epoch, CAST(NULL AS VARCHAR) AS from_garbage FROM events""",
    "decoded_props": "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, length(props) > 0 AS has_text FROM events",
    "result_cards": f"""SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page_id, o_orderkey AS ad_id, '{SITE}/item/' || o_orderkey AS ad_url,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(floor(o_totalprice) AS INTEGER) END AS price,
        o_orderpriority || ' ' || year(o_orderdate) AS specs_text, TIMESTAMP '2025-01-01' AS scraped_at FROM orders""",
    "next_pages": f"""SELECT DISTINCT CAST(floor(o_orderkey / 20) AS BIGINT) AS page_id,
        '{SITE}/search?page=' || (CAST(floor(o_orderkey / 20) AS BIGINT) + 1) AS next_url FROM orders""",
    "item_details": """SELECT p_partkey AS page_id,
        CAST(CASE WHEN p_partkey % 5 = 4 THEN p_partkey + 1000000 ELSE p_partkey END AS VARCHAR) AS ad_id,
        p_name AS title, p_brand AS make, p_type AS model,
        CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN p_size END AS seats,
        CASE WHEN p_partkey % 5 <> 4 THEN CAST(floor(p_retailprice) AS INTEGER) END AS price,
        CASE p_partkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'EUR' WHEN 2 THEN 'SEK' WHEN 3 THEN 'NOK' END AS currency,
        CASE WHEN p_partkey % 5 = 4 THEN 'Glassfiber' END AS material,
        CASE WHEN p_partkey % 5 IN (0, 1) THEN lpad(CAST(p_size AS VARCHAR), 4, '0') END AS postal_code,
        CASE WHEN p_partkey % 5 IN (0, 1) AND p_size BETWEEN 1 AND 1299 THEN 'Oslo' END AS municipality,
        CASE WHEN p_partkey % 5 IN (0, 3) THEN p_brand || '|' || p_type ELSE '' END AS equipment FROM part""",
    "item_conflicts": f"""WITH told AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, p_brand AS b, p_type AS t,
          CAST(floor(p_retailprice) AS INTEGER) AS m, p_partkey % 3 <> 0 AS f, p_partkey & 1 = 1 AS p, (p_partkey >> 1) & 1 = 1 AS l,
          (p_partkey >> 2) & 1 = 1 AS d, (p_partkey >> 3) & 1 = 1 AS c, (p_partkey >> 4) & 1 = 1 AS a FROM part)
        SELECT k AS page_id, {", ".join(f"{value} AS {name}" for name, value in _CONFLICT_FIELDS.items())} FROM told""",
    "article_details": rf"""SELECT page_id, nullif({_TEXT.format(t='h1')}, '') AS title, nullif(regexp_extract(url, '/([0-9]+)/*$', 1), '') AS ad_id,
        CAST(NULL AS INTEGER) AS price, CAST(NULL AS INTEGER) AS year FROM pages WHERE {_TEXT.format(t='h1')} <> ''""",
}
