"""Item page extraction on small hand-made pages, one per source block and one with conflicts."""

import datetime
import json
from html import escape
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from adlattice.operators.item_json import labelled_items
from adlattice.operators.items import parse_items
from adlattice.operators.quality import informative_rows


def page(body: str, head: str = "") -> str:
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


AD = {
    "title": "Fin båt > 30 fot",
    "year": 1998,
    "make": {"value": "Bavaria"},
    "boat_model": "Cruiser",
    "motor": {"make": "Volvo", "type": {"value": "Innenbords"}, "size": "29 hk"},
    "width": "330 cm",
    "depth": 0,
    "depth_cm": 170.9,
    "sleepers": "seks",
    "seats": 8,
    "weight": 5400,
    "material": {"value": "Glassfiber"},
    "boat_max_speed": "7",
    "location": {"position": {"lat": 59.9, "lng": "10.7"}, "postalCode": "0250", "county": "12"},
    "description": "En beskrivelse",
    "edited": "2024-05-01T10:00:00Z",
    "price": {"amount": "450000"},
    "images": ["a.jpg", "b.jpg"],
    "sections": [{"heading": "Annet", "items": ["x"]},
                 {"heading": " Utstyr ", "items": [{"label": "GPS"}, {"items": ["VHF", " "]}, "AIS"], "value": {"name": "Radar"}}],
}


def root(props: str) -> str:
    return page(f'<div class="x" id="mobility-item-page-root" data-props="{escape(props)}"><h1>Synlig</h1></div>')


GRID = """<section><h2>Nøkkelinfo</h2>
<div><p class="s-text-subtle">Modellår</p><p class="m0 font-bold">1987</p></div>
<div><label class="mb-0 s-text-subtle">Seter</label> <p class="font-bold">6 stk</p></div>
<div><p class="s-text-subtle">Lengde</p><p class="font-bold">28 fot</p></div></section>
<dl><div><dt>Modellår</dt><dd>1988</dd></div><div><dt>Merke</dt><dd> Maxi &aring;</dd></div><div><dt>Bredde</dt><dd>ukjent</dd></div>
<div><dt>Type motor</dt><dd>1</dd></div><div><dt>Ukjent</dt><dd>x</dd></div></dl>
<section><h2>Annonseinformasjon</h2><div class="text-m"><div><p class="s-text-subtle">Portal-kode</p><p class="font-bold">123456</p></div>
<div><p class="s-text-subtle">Sist endret</p><p class="font-bold">10. august 2025, 21:23</p></div></div></section>
<section><h2>Sted</h2><a href="/map?lat=58.1&amp;lon=7.9&amp;postalCode=4610"><span>4610 Kristiansand S</span></a></section>"""

LONG = "Båten er godt vedlikeholdt og klar for sesongen med nye seil og motor."

PAGES = {
    1: root(json.dumps(AD)),
    2: root(quote(json.dumps({"adData": AD}))),
    3: root(quote(quote(json.dumps({"ad": AD, "title": "other"})))),
    4: page(f"<div data-props='{{\"x\": 1}}'></div><div data-props=\"{escape(json.dumps({'ad': {'title': 'Any', 'price': 1200.9}}))}\"></div>"),
    5: page("", '<script type="application/ld+json">[{"@type":"X"},{"name":"LD","offers":{"price":"99000","priceCurrency":"SEK"},'
                '"brand":{"name":"Maxi"},"model":77,"address":{"postalCode":"0301","addressLocality":" 301 ","region":"Viken"}}]</script>'
                '<script type="application/ld+json">{"name":"Second"}</script>'),
    6: page("<h1> DOM <b>title</b></h1><div><p>Pris</p><h2>1 250 000 kr</h2></div>" + GRID
            + f"<section><h2>Beskrivelse</h2><div data-testid='expandable-section'><p>{LONG}</p><button>Vis mer</button></div></section>"
            + "<section><h2>Utstyr</h2><ul><li>GPS</li><li>CCS <b>lader</b></li><li> </li></ul></section>"),
    7: page('<script id="contact-button-data" type="application/json">{"adId": 777, "title": "Contact"}</script>'
            '<script id="advertising-initial-state">' + json.dumps({"config": {"adServer": {"gam": {"targeting": [
                {"key": "year", "value": ["2001"]}, {"key": "width", "value": ["3.4"]}, {"key": "engine_type", "value": ["1"]},
                {"key": "material", "value": [2]}, {"key": "boat_make", "value": []}, {"key": "county", "value": ["Agder"]}]}}}})
            + "</script>", '<meta name="description" content="Kort men lang nok beskrivelse">'),
    8: page(f'<div id="mobility-item-page-root" data-props="{escape(json.dumps({"title": "", "year": 0, "price": 5}))}"></div>'
            "<h1>From DOM</h1>" + '<script id="contact-button-data">{"title": "Contact"}</script>',
            '<link rel="canonical" href="https://x.example/item/424242/"><script type="application/ld+json">{"headline": "LD", "offers": {"price": 7}}</script>'),
    9: page("<p>please accept</p>"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, f"https://x.example/item/{9000 + i}", html) for i, html in PAGES.items()]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    result = parse_items(df, F.lit("2025-01-01").cast("timestamp")).cache()
    return {r["page_id"]: r for r in result.collect()}, result


@pytest.mark.parametrize("number", [1, 2, 3])
def test_props_in_three_encodings(parsed, number):
    row = parsed[0][number]
    assert row["title"] == "Fin båt > 30 fot"
    assert (row["year"], row["make"], row["model"]) == (1998, "Bavaria", "Cruiser")
    assert (row["engine_make"], row["engine_type"], row["engine_effect_hp"]) == ("Volvo", "Innenbords", 29)
    assert (row["width_cm"], row["depth_cm"], row["sleepers"], row["seats"]) == (330, 170, None, 8)
    assert (row["weight_kg"], row["material"], row["boat_max_speed_knots"]) == (5400, "Glassfiber", 7)
    assert (row["lat"], row["lng"], row["postal_code"]) == (59.9, 10.7, "0250")
    assert (row["municipality"], row["county"]) == ("Oslo", "Oslo")
    assert (row["price"], row["currency"]) == (450000, "NOK")
    assert row["equipment"] == ["GPS", "VHF", "AIS", "Radar"]
    assert row["images"] == ["a.jpg", "b.jpg"]
    assert row["last_edited_at"].replace(tzinfo=None) == datetime.datetime(2024, 5, 1, 10)
    assert row["ad_id"] == str(9000 + number)


def test_any_props_element(parsed):
    row = parsed[0][4]
    assert (row["title"], row["price"], row["currency"], row["equipment"]) == ("Any", 1200, "NOK", [])


def test_linked_data(parsed):
    row = parsed[0][5]
    assert (row["title"], row["price"], row["currency"], row["make"], row["model"]) == ("LD", 99000, "SEK", "Maxi", "77")
    assert (row["postal_code"], row["municipality"], row["county"]) == ("0301", "Oslo", "Viken")


def test_visible_page(parsed):
    row = parsed[0][6]
    assert (row["title"], row["price"], row["currency"]) == ("DOMtitle", 1250000, "NOK")
    assert (row["year"], row["seats"], row["make"], row["width_cm"], row["length_text"]) == (1988, 6, "Maxi å", None, "28 fot")
    assert row["engine_type"] == "Innenbords"
    assert (row["ad_id"], row["lat"], row["lng"], row["postal_code"]) == ("123456", 58.1, 7.9, "4610")
    assert row["municipality"] == "Kristiansand S"
    assert row["last_edited_at"].replace(tzinfo=None) == datetime.datetime(2025, 8, 10, 21, 23)
    assert row["description"] == LONG
    assert row["equipment"] == ["GPS", "CCS lader"]


def test_contact_and_advertising(parsed):
    row = parsed[0][7]
    assert (row["ad_id"], row["title"], row["year"], row["width_cm"]) == ("777", "Contact", 2001, None)
    assert (row["engine_type"], row["material"], row["make"], row["county"]) == ("Innenbords", "Glassfiber", None, "Agder")
    assert row["description"] == "Kort men lang nok beskrivelse"


def test_priority_and_id_fallback(parsed):
    row = parsed[0][8]
    assert row["title"] == "LD"  # the empty props title counts as missing, linked data comes before the page
    assert (row["price"], row["year"], row["ad_id"]) == (5, None, "424242")


def test_informative_gate_and_provenance(parsed):
    rows, result = parsed
    kept = {r["page_id"] for r in informative_rows(result).collect()}
    assert kept == set(range(1, 9))
    packs = json.loads(rows[6]["source_json"])
    assert packs["dom"]["postal_code"] == "4610" and "jsonld" in packs


def test_labelled_items_at_any_depth(spark):
    inner = {"heading": " Utstyr ", "items": ["GPS", " ", {"label": "VHF"}, {"title": "x", "children": [["AIS"]]}]}
    outer = {"title": "utstyr", "list": [inner], "other": 7}
    deep = outer
    for _ in range(400):
        deep = {"a": [deep]}
    texts = [json.dumps(deep), json.dumps(["A", [{"name": " ", "text": "B"}], {"value": "C", "text": "D"}]), None]
    df = spark.createDataFrame([(texts,), (None,)], "texts array<string>")
    rows = [r[0] for r in df.select(labelled_items("utstyr")("texts")).collect()]
    # The outer object is headed too: its own items come before those of the headed object inside it.
    assert rows == [[["GPS", "VHF", "AIS"] * 2, ["A", "B", "C"], []], []]
