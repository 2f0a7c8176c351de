"""Listing pages rendered from the given tables, so that extraction runs on as many pages as they have rows.

The given ``pages`` hold articles without listing markup; these carry one listing or one result page
each, in every layout the extractors know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.operators.items import ADVERTISING_ID, ADVERTISING_NUMBERS, ADVERTISING_TEXTS, CONTACT_ID, ROOT_ID
from adlattice.sources.tables import read_table, spread_scan

CARDS_PER_PAGE = 20
SITE = "https://market.example"


def escaped(text: Column) -> Column:
    """Text for use in HTML content or a quoted attribute."""
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def percent_encoded(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def wrapped(head: Column | str, body: Column) -> Column:
    head = F.lit(head) if isinstance(head, str) else head
    return F.concat(F.lit("<!DOCTYPE html><html><head><meta charset=\"utf-8\">"), head, F.lit("</head><body>"), body, F.lit("</body></html>"))


def item_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One item page per part: page_id, url, layout and html.

    Layouts 0 and 1 carry their fields as props (plain, percent-encoded), 2 as linked data, 3 as
    visible labels, 4 as contact and advertising blocks.
    """
    part = spread_scan(read_table(spark, sf, "part"), "p_partkey")
    key, price = F.col("p_partkey"), F.floor("p_retailprice").cast("int")
    ad = F.struct(
        F.col("p_name").alias("title"),
        F.struct(F.col("p_brand").alias("value")).alias("make"),
        F.col("p_type").alias("model"),
        F.concat(F.col("p_size").cast("string"), F.lit(" stk")).alias("seats"),
        F.struct(price.alias("amount"), F.lit("EUR").alias("currency")).alias("price"),
        F.struct(F.lpad(F.col("p_size").cast("string"), 4, "0").alias("postalCode")).alias("location"),
        F.array(F.struct(F.lit("Utstyr").alias("heading"), F.array("p_brand", "p_type").alias("items"))).alias("groups"),
    )
    props = F.to_json(F.struct(ad.alias("adData")))
    heading = F.concat(F.lit("<h1> "), escaped(F.col("p_name")), F.lit(" </h1>"))
    plain = wrapped("", F.concat(F.lit(f'<main id="{ROOT_ID}" data-props="'), escaped(props), F.lit('"></main>')))
    encoded = wrapped("", F.concat(F.lit('<div class="app" data-props="'), percent_encoded(props), F.lit('"></div>')))
    linked = wrapped(
        F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(
            F.col("p_name").alias("name"),
            F.struct(F.col("p_brand").alias("name")).alias("brand"),
            F.col("p_type").alias("model"),
            F.struct(price.alias("price"), F.lit("SEK").alias("priceCurrency")).alias("offers"),
        )), F.lit("</script>")),
        F.lit("<p>article</p>"),
    )
    visible = wrapped("", F.concat(
        heading,
        F.lit("<div><p>Pris</p><h2>"), F.format_number(price, 0), F.lit(" kr</h2></div><dl><div><dt>Merke</dt><dd>"), escaped(F.col("p_brand")),
        F.lit("</dd></div><div><dt>Modell</dt><dd>"), escaped(F.col("p_type")),
        F.lit("</dd></div><div><dt>Sitteplasser</dt><dd>"), F.col("p_size").cast("string"), F.lit(" personer</dd></div></dl>"),
        F.lit("<section><h2>Utstyr</h2><ul><li>"), escaped(F.col("p_brand")), F.lit("</li><li>"), escaped(F.col("p_type")),
        F.lit("</li></ul></section>"),
    ))
    state = F.to_json(F.struct(F.struct(F.struct(F.struct(F.array(
        F.struct(F.lit("boat_make").alias("key"), F.array("p_brand").alias("value")),
        F.struct(F.lit("boat_model").alias("key"), F.array("p_type").alias("value")),
        F.struct(F.lit("material").alias("key"), F.array(F.lit("2")).alias("value")),
    ).alias("targeting")).alias("gam")).alias("adServer")).alias("config")))
    scripts = wrapped("", F.concat(
        F.lit(f'<script id="{CONTACT_ID}" type="application/json">'),
        F.to_json(F.struct((key + 1_000_000).alias("adId"), F.col("p_name").alias("title"))),
        F.lit(f'</script><script id="{ADVERTISING_ID}" type="application/json">'), state, F.lit("</script>"),
    ))
    layout = (key % 5).cast("int")
    html = F.when(layout == 0, plain).when(layout == 1, encoded).when(layout == 2, linked).when(layout == 3, visible).otherwise(scripts)
    return part.select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/item/"), key.cast("string")).alias("url"), layout.alias("layout"), html.alias("html")
    )


def has_source(bit: int) -> Column:
    """Whether a part's conflicting page carries source number ``bit``: 0 props, 1 linked data, 2 visible, 3 contact, 4 advertising."""
    return F.expr(f"(p_partkey >> {bit}) & 1 = 1")


def conflicting_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One item page per part in which up to five sources tell different values for the same fields.

    Parts with a key divisible by 3 have an empty title and no make in their props, so that the next source must step in.
    """
    part = spread_scan(read_table(spark, sf, "part"), "p_partkey")
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.floor("p_retailprice").cast("int")
    told = lambda column, source: F.concat(F.col(column), F.lit(f" {source}"))
    number = lambda more: (size + more).cast("string")
    full = key % 3 != 0
    props = F.to_json(F.struct(F.struct(
        F.when(full, told("p_name", "props")).otherwise("").alias("title"),
        (size + 1900).alias("year"),
        F.struct(F.when(full, told("p_brand", "props")).alias("value")).alias("make"),
        told("p_type", "props").alias("boat_model"),
        F.struct(told("p_brand", "motor").alias("make"), F.struct(told("p_type", "motor").alias("value")).alias("type"),
                 F.concat(number(0), F.lit(" hk")).alias("size")).alias("motor"),
        F.concat(number(100), F.lit(" cm")).alias("width"), (size + 50).alias("depth_cm"), size.alias("sleepers"),
        number(1).alias("seats"), (size + 1000).alias("weight"), F.struct(F.lit("Tre").alias("value")).alias("material"),
        number(2).alias("boat_max_speed"), F.concat(F.lit("P"), key.cast("string")).alias("registration_number"),
        F.struct(F.struct((size * 0.5 + 50).alias("lat"), (size * 0.25).cast("string").alias("lng")).alias("position"),
                 number(2000).alias("postalCode"), F.lit("Vik").alias("postName"), F.lit("Agder").alias("county")).alias("location"),
        F.when(full, told("p_name", "as the props describe it")).alias("description"),
        F.lit("2024-05-01T10:00:00Z").alias("edited"),
        F.struct(price.alias("amount"), F.lit("EUR").alias("currency")).alias("price"),
        F.array(F.lit("a.jpg"), F.lit("b.jpg")).alias("images"),
        F.array(F.struct(F.lit("Utstyr").alias("heading"), F.array("p_brand", "p_type").alias("items"))).alias("groups"),
    ).alias("adData")))
    linked = F.to_json(F.struct(
        told("p_name", "linked").alias("name"), F.struct(told("p_brand", "linked").alias("name")).alias("brand"),
        told("p_type", "linked").alias("model"), F.struct((price + 1).alias("price"), F.lit("SEK").alias("priceCurrency")).alias("offers"),
        F.struct(number(3000).alias("postalCode"), F.lit("Lier").alias("addressLocality"), F.lit("Viken").alias("addressRegion")).alias("address"),
    ))
    grid = [
        ("modellår", number(1800)), ("Type motor", F.lit("grid motor")), ("Seter", number(60)), ("Lengde", F.concat(number(0), F.lit(" fot"))),
    ]
    specs = [
        ("Modellår", F.when(full, number(1850)).otherwise("ukjent")), ("Merke", told("p_brand", "spec")), ("Modell", told("p_type", "spec")),
        ("Type motor", F.when(full, F.lit("1"))), ("Motorfabrikant", F.lit("Spec & Co")), ("Motorstørrelse", F.concat(number(10), F.lit(" hk"))),
        ("Byggemateriale", F.lit("2")), ("Bredde", F.concat(number(300), F.lit(" cm"))), ("Dybde", F.concat(number(80), F.lit(" cm"))),
        ("Soveplasser", number(5)), ("Sitteplasser", number(6)), ("Topphastighet", F.concat(number(7), F.lit(" knop"))),
        ("Registreringsnummer", F.concat(F.lit("D"), key.cast("string"))), ("Lengde i fot", F.concat(number(20), F.lit(" fot"))),
        ("Drivstoff", F.lit("Diesel")), ("Type", told("p_type", "boat")), ("Farge", F.lit("Hvit")), ("Båtens beliggenhet", F.lit("Norge")),
    ]
    info = [("Portal-kode", (key + 500_000).cast("string")), ("Sist endret", F.lit("10. august 2025, 21:23"))]
    pair = lambda label, value: F.concat(
        F.lit(f'<div><p class="s-text-subtle">{label}</p><p class="font-bold">'), escaped(value), F.lit("</p></div>"))
    row = lambda label, value: F.coalesce(F.concat(F.lit(f"<div><dt>{label}</dt><dd>"), escaped(value), F.lit("</dd></div>")), F.lit(""))
    visible = F.concat(
        F.lit("<h1>"), escaped(told("p_name", "visible")), F.lit("</h1><div><p>Pris</p><h2>"), F.format_number(price + 2, 0),
        F.lit(" kr</h2></div><section><h2>Nøkkelinfo</h2>"), *[pair(*entry) for entry in grid], F.lit("</section><dl>"),
        *[row(*entry) for entry in specs], F.lit("</dl><section><h2>Annonseinformasjon</h2>"), *[pair(*entry) for entry in info],
        F.lit('</section><section><h2>Sted</h2><a href="/map?lat='), (size * 0.5 + 60).cast("string"), F.lit("&amp;lon="),
        (size * 0.25 + 5).cast("string"), F.lit("&amp;postalCode="), number(4000), F.lit('"><span>'), number(4000),
        F.lit(" Kristiansand S</span></a></section><section><h2>Beskrivelse</h2><div data-testid=\"expandable-section\"><p>"),
        escaped(told("p_name", "is described in the visible page, in more than fifty characters")),
        F.lit("</p><button>Vis mer</button></div></section><section><h2>Utstyr</h2><ul><li>GPS</li><li>"), escaped(F.col("p_brand")),
        F.lit("</li></ul></section>"),
    )
    contact = F.to_json(F.struct((key + 1_000_000).alias("adId"), told("p_name", "contact").alias("title")))
    targets = [(name, number(1700 + i)) for i, name in enumerate(ADVERTISING_NUMBERS.values())]
    targets += [(name, F.concat(F.lit(f"{name} "), number(0))) for name in ADVERTISING_TEXTS.values()]
    advertising = F.to_json(F.struct(F.struct(F.struct(F.struct(F.array(
        *[F.struct(F.lit(name).alias("key"), F.array(value).alias("value")) for name, value in targets]
    ).alias("targeting")).alias("gam")).alias("adServer")).alias("config")))
    present = lambda bit, *parts: F.when(has_source(bit), F.concat(*parts)).otherwise("")
    head = F.concat(
        F.when(key % 3 == 1, F.concat(F.lit(f'<link rel="canonical" href="{SITE}/item/'), (key + 7_000_000).cast("string"), F.lit('">')))
        .when(key % 3 == 2, F.concat(F.lit(f'<meta property="og:url" content="{SITE}/item/'), (key + 8_000_000).cast("string"), F.lit('">')))
        .otherwise(""),
        F.lit('<meta name="description" content="Meta text of '), escaped(F.col("p_name")), F.lit(' in short">'),
        present(1, F.lit('<script type="application/ld+json">'), linked, F.lit("</script>")),
    )
    body = F.concat(
        present(0, F.lit(f'<main id="{ROOT_ID}" data-props="'), escaped(props), F.lit('"></main>')),
        present(2, visible),
        present(3, F.lit(f'<script id="{CONTACT_ID}" type="application/json">'), contact, F.lit("</script>")),
        present(4, F.lit(f'<script id="{ADVERTISING_ID}" type="application/json">'), advertising, F.lit("</script>")),
    )
    return part.select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/item/"), key.cast("string")).alias("url"), wrapped(head, body).alias("html")
    )


def result_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Result pages with 20 order cards each (fewer on the last): page_id, url and html."""
    orders = read_table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    no_price = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    card = F.concat(
        F.lit('<article class="isolate relative x sf-search-ad"><a id="search-ad-'), key,
        F.lit('" class="sf-search-ad-link s" href="'),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(SITE), F.lit("/item/"), key)).otherwise(F.concat(F.lit("/item/"), key)),
        F.lit('"><span>title</span></a><span class="text-caption font-bold inline-block">'), F.col("o_orderpriority"),
        F.lit(" <b>"), F.year("o_orderdate").cast("string"), F.lit("</b></span>"),
        F.when(no_price, F.lit("")).otherwise(F.concat(
            F.lit('<span class="t3 font-bold inline-block">'), F.format_number(F.floor("o_totalprice"), 0), F.lit(" kr</span>")
        )),
        F.lit("</article>"),
    )
    page = F.floor(F.col("o_orderkey") / CARDS_PER_PAGE).cast("bigint")
    # At most CARDS_PER_PAGE rows per group, as the order key is unique.
    grouped = orders.groupBy(page.alias("page_id")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", card.alias("card")))), lambda c: c["card"]), "").alias("cards")
    )
    following = F.concat(F.lit('<a rel="next" href="?page='), (F.col("page_id") + 1).cast("string"), F.lit('">next</a>'))
    return grouped.select(
        "page_id",
        F.concat(F.lit(f"{SITE}/search?page="), F.col("page_id").cast("string")).alias("url"),
        wrapped("", F.concat(F.col("cards"), following)).alias("html"),
    )
