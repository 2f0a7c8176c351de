"""Item pages to typed listing details: five extracts per page, merged by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.html import (
    TAG_REST, all_matches, attribute, block_under, element, first_match, has_attribute, has_classes, headed_blocks, holding,
    label_value_pairs, last_value, once, open_tag, quoted, sql, texts_of, trimmed, visible_text,
)
from adlattice.functions.scalars import (
    all_digits, digits_int, localised_date, non_empty, parsed_timestamp, strip, url_tail_id,
)
from adlattice.operators.item_json import (
    Fields, coalesced, first_non_empty, first_scalar, first_whole_number, from_first, is_object, labelled_items,
    number_or_text, quoted_scalar, scalar, strict_integer, tolerant_json,
)

DEFAULT_CURRENCY = "NOK"

# Page ids, headings and labels of the site's item pages (fixed values).
ROOT_ID = "mobility-item-page-root"
CONTACT_ID = "contact-button-data"
ADVERTISING_ID = "advertising-initial-state"
DESCRIPTION_HEADING = "beskrivelse"
EQUIPMENT_HEADING = "utstyr"
PLACE_HEADING = "sted"
PRICE_LABEL = "pris"
EDITED_LABEL = "sist endret"
# Ending of the label in front of the listing id; the site puts its own name before it.
ID_LABEL = "-kode"

GRID_LABELS = {"modellår": "year", "type motor": "engine_type", "seter": "seats", "lengde": "length_text"}

SPEC_LABELS = {
    "modellår": "year",
    "merke": "make",
    "modell": "model",
    "type motor": "engine_type",
    "motorfabrikant": "engine_make",
    "motorstørrelse": "engine_effect_hp",
    "byggemateriale": "material",
    "bredde": "width_cm",
    "dybde": "depth_cm",
    "soveplasser": "sleepers",
    "sitteplasser": "seats",
    "topphastighet": "boat_max_speed_knots",
    "registreringsnummer": "registration_number",
    "lengde i fot": "length_ft",
    "drivstoff": "fuel_type",
    "type": "boat_type",
    "farge": "color",
    "båtens beliggenhet": "country_name",
}
NUMERIC_SPECS = [
    "year", "engine_effect_hp", "width_cm", "depth_cm", "sleepers", "seats", "boat_max_speed_knots", "length_ft",
]

# Advertising keys and the fields they fill.
ADVERTISING_NUMBERS = {
    "year": "year", "width_cm": "width", "depth_cm": "depth", "sleepers": "sleepers",
    "engine_effect_hp": "engine_effect", "boat_max_speed_knots": "boat_max_speed",
}
ADVERTISING_TEXTS = {
    "engine_make": "engine_make", "engine_type": "engine_type", "material": "material", "make": "boat_make",
    "model": "boat_model", "registration_number": "registration_number", "municipality": "municipality", "county": "county",
}

# Codes seen in place of labels.
CODE_LABELS = {"engine_type": {"1": "Innenbords"}, "material": {"2": "Glassfiber"}}

# Postal code ranges: first, last, municipality, county.
POSTAL_RANGES = [(1, 1299, "Oslo", "Oslo")]

INTEGER_FIELDS = [
    "year", "width_cm", "depth_cm", "sleepers", "seats", "engine_effect_hp", "boat_max_speed_knots", "weight_kg", "price",
]
TEXT_FIELDS = [
    "title", "description", "make", "model", "material", "engine_make", "engine_type", "registration_number",
    "municipality", "county", "postal_code", "currency", "ad_id",
]

Pack = dict[str, Column]


# -- props: JSON in an attribute -------------------------------------------------------------------


# Any element with props, and the root element.
PROPS_TAG = rf"""(?is)<[a-z][a-z0-9]*\s(?=[^<]*?data-props\s*=){TAG_REST}"""
ROOT_MARK = rf"""(?is)\sid\s*=\s*["']{ROOT_ID}["']"""
ROOT_TAG = rf"""(?is)<[a-z][a-z0-9]*\s(?:[^<]*?\s)?id\s*=\s*["']{ROOT_ID}["']"""


def props_texts(html: str, has_root: str) -> str:
    """Props of the root element if the page has one, else of all elements that carry any."""
    chosen = f"filter({all_matches(html, PROPS_TAG)}, m -> NOT {has_root} OR m RLIKE {quoted(ROOT_MARK)})"
    return f"filter(transform({chosen}, m -> {attribute('m', 'data-props')}), a -> a IS NOT NULL)"


def props_root(texts: str, has_root: str) -> Column:
    """(obj, ad) variants of the first usable props block.

    Under the root element any object will do and may be the listing itself; elsewhere only a block
    with an ``adData`` or ``ad`` object counts.
    """
    parsed = F.transform(F.expr(texts), tolerant_json)
    parts = F.transform(parsed, lambda v: F.struct(
        F.when(is_object(v), v).alias("obj"),
        F.try_variant_get(v, "$.adData", "variant").alias("data"),
        F.try_variant_get(v, "$.ad", "variant").alias("ad"),
    ))
    candidates = F.transform(parts, lambda c: F.struct(
        c["obj"].alias("obj"),
        F.coalesce(
            F.when(is_object(c["data"]), c["data"]), F.when(is_object(c["ad"]), c["ad"]), F.when(F.col(has_root), c["obj"])
        ).alias("ad"),
    ))
    return F.get(F.filter(candidates, lambda c: c["ad"].isNotNull()), F.lit(0))


# Paths read from a props listing and from its outer object (fixed values).
AD_FIELDS = Fields([
    "title", "year", "make", "make.value", "model", "boat_model", "motor.make", "engine_make", "motor.type",
    "motor.type.value", "motor_type", "motor_type.value", "motor.size", "engine_effect", "width", "width_cm", "depth",
    "depth_cm", "sleepers", "seats", "weight", "weight_kg", "material", "material.value", "boat_max_speed",
    "registration_number", "location.position.lat", "location.position.lng", "location.postalCode",
    "location.postal_code", "location.postName", "location.municipality", "location.county", "description", "edited",
    "price", "price.amount", "price.currency", "priceInfo", "priceInfo.amount", "priceInfo.currency",
    "equipment", "equipment_safe", "equipment_unsafe",
])
OUTER_FIELDS = Fields(["title", "year", "description", "edited", "equipment", "equipment_safe", "equipment_unsafe"])

# Keys of the plain equipment fields, tried when no heading is found (fixed values).
EQUIPMENT_KEYS = ["equipment", "equipment_safe", "equipment_unsafe"]
ITEM_TAGS = r"(?is)<(li|p)\b[^>]*>(.*?)</\1\s*>"


def props_pack(outer: Fields, ad: Fields) -> Pack:
    """Fields of the props block, each from the first of its known places."""
    amount = coalesced(ad["price"].raw, f"if(startswith({ad['priceInfo'].raw}, '{{'), {ad['priceInfo'].raw}, NULL)")
    structured, number = f"startswith({amount}, '{{')", f"{amount} RLIKE '^-?[0-9]'"
    has_price = f"{ad['price'].raw} IS NOT NULL"
    inner_amount = f"if({has_price}, {ad['price.amount'].json}, {ad['priceInfo.amount'].json})"
    inner_currency = f"if({has_price}, {scalar(ad['price.currency'])}, {scalar(ad['priceInfo.currency'])})"
    motor_type = lambda path: first_scalar(ad[f"{path}.value"], ad[path])

    edited = F.expr(coalesced(ad["edited"].raw, outer["edited"].raw))
    edited_text = F.expr(first_scalar(ad["edited"], outer["edited"]))
    fields = {
        "title": first_scalar(ad["title"], outer["title"]),
        "year": from_first(number_or_text, ad["year"], outer["year"]),
        "make": first_scalar(ad["make.value"], ad["make"]),
        "model": first_scalar(ad["model"], ad["boat_model"]),
        "engine_make": first_scalar(ad["motor.make"], ad["engine_make"]),
        "engine_type": f"if({ad['motor.type'].raw} IS NOT NULL, {motor_type('motor.type')}, {motor_type('motor_type')})",
        "engine_effect_hp": first_whole_number(ad["motor.size"], ad["engine_effect"]),
        "width_cm": first_whole_number(ad["width"], ad["width_cm"]),
        "depth_cm": first_whole_number(ad["depth"], ad["depth_cm"]),
        "sleepers": first_whole_number(ad["sleepers"]),
        "seats": first_whole_number(ad["seats"]),
        "weight_kg": first_whole_number(ad["weight"], ad["weight_kg"]),
        "material": first_scalar(ad["material.value"], ad["material"]),
        "boat_max_speed_knots": first_whole_number(ad["boat_max_speed"]),
        "registration_number": scalar(ad["registration_number"]),
        "lat": f"try_cast({ad['location.position.lat'].text} AS double)",
        "lng": f"try_cast({ad['location.position.lng'].text} AS double)",
        "postal_code": first_scalar(ad["location.postalCode"], ad["location.postal_code"]),
        "municipality": first_scalar(ad["location.postName"], ad["location.municipality"]),
        "county": scalar(ad["location.county"]),
        "description": first_scalar(ad["description"], outer["description"]),
        "price": f"if({structured}, {strict_integer(inner_amount)}, if({number}, {strict_integer(amount)}, NULL))",
        "currency": f"if({structured}, coalesce({inner_currency}, '{DEFAULT_CURRENCY}'), if({number}, '{DEFAULT_CURRENCY}', NULL))",
        "images": "try_variant_get(props.ad, '$.images', 'array<string>')",
    }
    return {
        **{name: F.expr(text) for name, text in fields.items()},
        "last_edited_at": F.when(
            edited.startswith('"'), F.when(~edited_text.rlike("^[0-9]+$"), parsed_timestamp(edited_text))
        ).otherwise(F.timestamp_seconds(edited.try_cast("double"))),
    }


def equipment_inputs(outer: Fields, ad: Fields) -> Column:
    """JSON texts for the equipment search: the whole block if it has the heading, then the fallback lists.

    Only props of the root element are searched.
    """
    block = "if(has_root, to_json(props.obj), NULL)"
    searched = f"get(transform(array({block}), b -> if(contains(lower(b), '{EQUIPMENT_HEADING}'), b, NULL)), 0)"
    lists = []
    for key in EQUIPMENT_KEYS:
        text = coalesced(ad[key].raw, outer[key].raw)
        lists.append(f"if(has_root AND startswith({text}, '['), {text}, NULL)")
    return F.expr(f"array({', '.join([searched, *lists])})")


def equipment_of(found: Column, outer: Fields, ad: Fields) -> Column:
    """The first equipment list found: by heading, then per fallback key its list or its HTML items."""
    steps = [F.get(found, F.lit(0))]
    for i, key in enumerate(EQUIPMENT_KEYS):
        text = f"if(has_root, {first_scalar(ad[key], outer[key])}, NULL)"
        items = f"coalesce({texts_of(text, ITEM_TAGS, 2, '')}, CAST(array() AS array<string>))"
        steps += [F.get(found, F.lit(i + 1)), sql(items)]
    return first_non_empty(F.array(*steps))


# -- JSON in script elements -------------------------------------------------------------------------


def script_json(html: str, element_id: str) -> Column:
    return sql(f"try_parse_json({first_match(html, element('script', has_attribute('id', element_id)), 1)})")


LINKED_FIELDS = Fields([
    "name", "headline", "offers.price", "offers.priceCurrency", "offers.currency", "brand.name", "model",
    "address.postalCode", "address.postal_code", "address.addressLocality", "address.locality",
    "address.address_locality", "address.addressRegion", "address.region", "address.address_region",
])


LINKED_SCRIPT = element("script", has_attribute("type", r"application/ld\+json"))


def linked_objects(html: str) -> Column:
    """Objects of every linked-data script: array of arrays of variants."""
    listed = "coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))"
    objects = f"filter({listed}, o -> try_variant_get(o, '$', 'struct<a: variant>') IS NOT NULL)"
    return sql(f"transform(transform({all_matches(html, LINKED_SCRIPT, 1)}, s -> try_parse_json(s)), v -> {objects})")


def json_ld_pack(html: str, low: str, objects: str) -> Pack:
    """Title, price, brand, model and address of the first linked-data script that yields anything.

    ``objects`` is a column of :func:`linked_objects`.
    """
    o = LINKED_FIELDS.bound("o")
    postal = from_first(quoted_scalar, o["address.postalCode"], o["address.postal_code"])

    def place(*names: str) -> str:
        return f"nullif(trim({from_first(quoted_scalar, *[o[f'address.{n}'] for n in names])}), '')"

    fields = {
        "title": from_first(quoted_scalar, o["name"], o["headline"]),
        "price": strict_integer(o["offers.price"].json),
        "currency": from_first(quoted_scalar, o["offers.priceCurrency"], o["offers.currency"]),
        "make": quoted_scalar(o["brand.name"]),
        "model": scalar(o["model"]),
        "postal_code": f"if({postal} RLIKE '^[0-9]+$', {postal}, NULL)",
        "municipality": place("addressLocality", "locality", "address_locality"),
        "county": place("addressRegion", "region", "address_region"),
    }
    # Within a script the first object with a field gives it, but a later price replaces an earlier one.
    position = {name: -1 if name in ("price", "currency") else 1 for name in fields}
    values = ", ".join(
        f"try_element_at(filter(transform(objs, o -> {text}), x -> x IS NOT NULL), {position[name]}) AS {name}"
        for name, text in fields.items()
    )
    any_field = " OR ".join(f"p.{name} IS NOT NULL" for name in fields)
    read = f"transform({objects}, vs -> transform(vs, v -> {LINKED_FIELDS.reading('v')}))"
    used = F.expr(f"get(filter(transform({read}, objs -> struct({values})), p -> {any_field}), 0)")
    titled = holding(html, low, "og:title")
    meta = sql(attribute(first_match(titled, open_tag("meta", has_attribute("property", "og:title"))), "content"))
    pack = {name: used[name] for name in fields}
    return {**pack, "title": F.coalesce(pack["title"], meta)}


def contact_pack(contact: str) -> Pack:
    return {
        "ad_id": F.try_variant_get(F.col(contact), "$.adId", "string"),
        "title": non_empty(F.try_variant_get(F.col(contact), "$.title", "string")),
    }


def advertising_targets(state: Column) -> Column:
    """Targeting entries as array<(key, value list)>."""
    targeting = F.to_json(F.try_variant_get(state, "$.config.adServer.gam.targeting", "variant"))
    return F.from_json(targeting, "array<struct<key: string, value: array<string>>>")


def advertising_pack(targets: str) -> Pack:
    """Year, sizes, engine and place from the targeting entries: the first value of each key."""

    def first_value(key: str) -> str:
        # The last entry of a key counts; the position is 0 without one, for which NULL is the index.
        return f"get(get(reverse({targets}.value), int(nullif(array_position(reverse({targets}.key), '{key}'), 0)) - 1), 0)"

    numbers = {
        field: F.expr(f"if({first_value(key)} RLIKE '^ *[+-]?[0-9]+ *$', try_cast(trim({first_value(key)}) AS int), NULL)")
        for field, key in ADVERTISING_NUMBERS.items()
    }
    return {**numbers, **{field: F.expr(first_value(key)) for field, key in ADVERTISING_TEXTS.items()}}


# -- visible page ------------------------------------------------------------------------------------


EXPANDABLE = r"""(?is)(<[a-z0-9]+\b[^>]*data-testid\s*=\s*["']expandable-section["'].*)$"""


def visible_description(blocks: str, html: str, low: str) -> str:
    """Text under the description heading (more than 50 characters), else the meta description (more than 20)."""

    def without_buttons(text: str) -> str:
        return trimmed(f"replace(replace({text}, 'Vis mer', ''), 'Show more', '')")

    section = visible_text(f"if(e != '', e, b.body)")
    section = once(f"regexp_extract(b.body, {quoted(EXPANDABLE)}, 1)", "e", section)
    cleaned = without_buttons(trimmed("replace(s, 'Beskrivelse', '')"))
    in_section = once(section, "s", f"if(b.in_section AND length(s) > 50 AND length({cleaned}) > 50, {cleaned}, NULL)")
    following = visible_text(f"regexp_extract(b.body, {quoted(r'(?is)(<div[ >].*)$')}, 1)")
    following = once(following, "f", f"if(length(f) > 50, nullif({without_buttons('f')}, ''), NULL)")
    described = f"filter({blocks}, b -> contains(lower(b.heading), '{DESCRIPTION_HEADING}'))"
    found = f"get(filter(transform({described}, b -> coalesce({in_section}, {following})), d -> d IS NOT NULL), 0)"
    meta = first_match(holding(html, low, "description"), open_tag("meta", has_attribute("name", "description")))
    meta = trimmed(attribute(meta, "content"))
    return f"coalesce({found}, {once(meta, 'm', 'if(length(m) > 20, m, NULL)')})"


def visible_price(html: str, low: str) -> Column:
    """Number in the h2 next to the price label, else in the first price span."""
    labelled = f"regexp_extract({holding(html, low, PRICE_LABEL)}, {quoted(rf'(?is)<p[^>]*>[ ]*{PRICE_LABEL}[ ]*</p[ ]*>(.*?)(?:</div|</section|$)')}, 1)"
    beside = digits_int(sql(visible_text(first_match(labelled, element("h2"), 1), "")))
    span = visible_text(first_match(holding(html, low, "t2"), element("span", has_classes("t2")), 1), "")
    return F.coalesce(beside, digits_int(sql(span)))


def visible_pack(html: str, low: str, blocks: str, grid: str, specs: str, anchor: str) -> Pack:
    """Fields of the visible page; specification pairs go over grid pairs.

    ``low`` is the page in lower case, ``grid`` and ``specs`` are columns of label and value pairs, ``anchor`` the link under the place
    heading as (href, text).
    """

    def parameter(name: str) -> Column:
        return sql(f"try_url_decode(nullif(regexp_extract({anchor}.href, '[?&]{name}=([^&#]*)', 1), ''))")

    place = F.col(f"{anchor}.text")
    after_code = F.regexp_extract(place, r"^[0-9]+\s+(.+)$", 1)
    equipment = sql(texts_of(block_under(blocks, EQUIPMENT_HEADING), ITEM_TAGS, 2))
    listed = F.filter(grid, lambda p: p["label"].contains(ID_LABEL) & all_digits(p["value"]))
    edited = F.filter(grid, lambda p: p["label"].contains(EDITED_LABEL) & localised_date(p["value"]).isNotNull())

    pack: Pack = {}
    for label, field in GRID_LABELS.items():
        value = sql(last_value(grid, label))
        pack[field] = digits_int(value) if field in ("year", "seats") else value
    for label, field in SPEC_LABELS.items():
        value = sql(last_value(specs, label))
        value = digits_int(value) if field in NUMERIC_SPECS else value
        pack[field] = F.coalesce(value, pack[field]) if field in pack else value
    price = visible_price(html, low)
    return {
        **pack,
        "title": non_empty(sql(visible_text(first_match(holding(html, low, "<h1"), element("h1"), 1), ""))),
        "description": sql(visible_description(blocks, html, low)),
        "price": price,
        "currency": F.when(price.isNotNull(), F.lit(DEFAULT_CURRENCY)),
        "equipment": F.when(F.size(equipment) > 0, equipment),
        "ad_id": F.try_element_at(listed, F.lit(-1))["value"],
        "last_edited_at": localised_date(F.try_element_at(edited, F.lit(-1))["value"]),
        "lat": parameter("lat").try_cast("double"),
        "lng": parameter("lon").try_cast("double"),
        "postal_code": F.when(all_digits(parameter("postalCode")), parameter("postalCode")),
        "municipality": F.when(after_code != "", after_code).when(~place.rlike("^[0-9]+$"), non_empty(place)),
    }


GRID_PATTERN = (
    r"(?is)<(label|p)\b" + has_classes("s-text-subtle") + r"[^>]*>(.*?)</\1\s*>\s*"
    r"""<p\b(?=[^>]*\sclass\s*=\s*["'][^"']*font-bold)[^>]*>(.*?)</p\s*>"""
)
SPEC_PATTERN = r"(?is)<dt\b[^>]*>(.*?)</dt\s*>\s*<dd\b[^>]*>(.*?)</dd\s*>"


# -- merge and normalise -----------------------------------------------------------------------------


def as_struct(pack: Pack) -> Column:
    return F.struct(*[value.alias(name) for name, value in pack.items()])


def merged_field(name: str, packs: dict[str, Pack]) -> Column:
    """First extract, by priority, with a value; '' and [] count as missing, 0 does not."""
    values = []
    for column, pack in packs.items():
        if name in pack:
            value = F.col(column)[name]
            if name == "equipment":
                value = F.when(F.size(value) > 0, value)
            elif name in TEXT_FIELDS or name in INTEGER_FIELDS:
                value = non_empty(value.cast("string"))
            values.append(value)
    return F.coalesce(*values)


def code_label(value: Column, field: str) -> Column:
    """Readable label of a code; other values unchanged."""
    labels = CODE_LABELS[field]
    chain = value
    for code, label in labels.items():
        chain = F.when(value == code, F.lit(label)).otherwise(chain)
    return chain


def with_place_of_code(df: DataFrame, ranges: list[tuple[int, int, str, str]] = POSTAL_RANGES) -> DataFrame:
    """Municipality and county by four-digit postal code, where missing or only a number.

    The ranges are a literal lookup: a range join against a broadcast table of the same size.
    """
    code = F.when(F.col("postal_code").rlike("^[0-9]{4}$"), F.col("postal_code").try_cast("int"))
    municipality = county = F.lit(None).cast("string")
    for low, high, town, region in ranges:
        inside = code.between(low, high)
        municipality = F.when(inside, F.lit(town)).otherwise(municipality)
        county = F.when(inside, F.lit(region)).otherwise(county)
    unknown = lambda c: F.col(c).isNull() | F.col(c).rlike("^[0-9]+$")
    return df.withColumns({
        "municipality": F.when(unknown("municipality") & municipality.isNotNull(), municipality).otherwise(F.col("municipality")),
        "county": F.when(unknown("county") & county.isNotNull(), county).otherwise(F.col("county")),
    })


def evaluated(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus new columns, each computed exactly once per row at this point of the plan.

    The columns pass through a generator, across which the optimizer moves no predicate and merges no
    projection; without it every later mention of a field would repeat its whole extraction. They are
    computed in the projection below it, which Spark compiles and in which it shares equal parts.
    """
    return df.select(*keep, as_struct(columns).alias("__row")).select(*keep, F.inline(F.array("__row")))


def parse_items(pages: DataFrame, scraped_at: Column) -> DataFrame:
    """Typed details of every item page (page_id, url, html), with the raw extracts as ``source_json``.

    Every extract stays on the page's row, so pages of any number are parsed in one narrow stage.
    """
    html, low, keys = "html", "low", ["page_id", "url", "html", "low"]

    def where(mark: str) -> str:
        return holding(html, low, mark)

    # Patterns ignore case, so a page whose lower case lacks a text of the pattern is not looked through for it.
    lowered = pages.select("page_id", "url", "html", F.lower(html).alias(low))
    sources = evaluated(lowered, keys, {
        "has_root": F.expr(where(ROOT_ID)).rlike(ROOT_TAG),
        "contact_json": script_json(where(CONTACT_ID), CONTACT_ID),
        "linked": linked_objects(where("application/ld+json")),
        "targets": advertising_targets(script_json(where(ADVERTISING_ID), ADVERTISING_ID)),
        "blocks": sql(headed_blocks(where("<h2"))),
        "grid": sql(label_value_pairs(where("s-text-subtle"), GRID_PATTERN, 2, 3)),
        "specs": sql(label_value_pairs(where("<dt"), SPEC_PATTERN, 1, 2)),
        "canonical": sql(attribute(first_match(where("canonical"), open_tag("link", has_attribute("rel", "canonical"))), "href")),
        "og_url": sql(attribute(first_match(where("og:url"), open_tag("meta", has_attribute("property", "og:url"))), "content")),
    })
    found = evaluated(sources, sources.columns, {
        "props": props_root(props_texts(where("data-props"), "has_root"), "has_root"),
        "place": sql(once(
            first_match(block_under("blocks", PLACE_HEADING), r"(?is)<a\b(?=[^>]*\shref\s*=)[^>]*>.*?</a\s*>"), "a",
            f"struct({attribute('a', 'href')} AS href, {visible_text('a', '')} AS text)",
        )),
    })
    outer, ad = OUTER_FIELDS.bound("outer_fields"), AD_FIELDS.bound("ad_fields")
    read = evaluated(found, found.columns, {
        "outer_fields": F.expr(OUTER_FIELDS.reading("props.obj")), "ad_fields": F.expr(AD_FIELDS.reading("props.ad")),
    })
    searched = read.withColumn("items", labelled_items(EQUIPMENT_HEADING)(equipment_inputs(outer, ad)))
    props = {**props_pack(outer, ad), "equipment": equipment_of(F.col("items"), outer, ad)}
    packs = {
        "data_props": props,
        "jsonld": json_ld_pack(html, low, "linked"),
        "dom": visible_pack(html, low, "blocks", "grid", "specs", "place"),
        "contact": contact_pack("contact_json"),
        "advertising": advertising_pack("targets"),
    }
    extracted = evaluated(searched, ["page_id", "url", "canonical", "og_url"], {n: as_struct(p) for n, p in packs.items()})

    names = list(dict.fromkeys(name for pack in packs.values() for name in pack))
    merged = evaluated(extracted, ["page_id", "url"], {
        **{name: merged_field(name, packs) for name in names if name != "ad_id"},
        "ad_id": F.coalesce(merged_field("ad_id", packs), url_tail_id(F.coalesce("canonical", "og_url")), url_tail_id("url")),
        "source_json": F.to_json(F.struct(*packs), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}),
    })
    typed = merged.withColumns({
        **{name: digits_int(name) for name in INTEGER_FIELDS},
        "engine_type": code_label(F.col("engine_type"), "engine_type"),
        "material": code_label(F.col("material"), "material"),
        "equipment": F.coalesce("equipment", F.array().cast("array<string>")),
        "scraped_at": scraped_at,
    })
    priced = typed.withColumn(
        "currency", F.when(F.col("price").isNotNull(), F.coalesce("currency", F.lit(DEFAULT_CURRENCY))).otherwise(F.col("currency"))
    )
    return with_place_of_code(priced)
