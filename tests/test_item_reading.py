"""Item pages are read by compiled projections, and marks that skip a pattern ignore case as the patterns do."""

import re

from pyspark.sql import functions as F

from adlattice.functions.html import attribute, decode_entities, last_value, sql, visible_text
from adlattice.operators.items import parse_items
from adlattice.plans import page_queries


def test_no_generator_computes_anything(spark):
    plan = page_queries.item_conflicts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    generators = re.findall(r"Generate inline\(array\((\w+)", plan)
    assert len(generators) == plan.count("Generate inline(") == 5 and set(generators) == {"__row"}
    assert "get_json_object" not in plan


def test_marks_ignore_case(spark):
    html = ("<HTML><LINK REL='Canonical' HREF='/item/77'><MAIN ID='Mobility-Item-Page-Root' DATA-PROPS='{\"year\": 1999}'></MAIN>"
            "<H1>Upper</H1><P>PRIS</P><H2>12 000 kr</H2><DL><DT>Merke</DT><DD>Maxi</DD></DL>"
            "<SCRIPT TYPE='APPLICATION/LD+JSON'>{\"model\": \"LD\"}</SCRIPT>")
    pages = spark.createDataFrame([(1, "", html), (2, "", None), (3, "", "")], "page_id bigint, url string, html string")
    rows = {r["page_id"]: r for r in parse_items(pages, F.lit("2025-01-01").cast("timestamp")).collect()}
    one = rows[1]
    assert (one["title"], one["price"], one["make"], one["model"], one["year"], one["ad_id"]) == ("Upper", 12000, "Maxi", "LD", 1999, "77")
    assert {rows[2]["title"], rows[2]["ad_id"], rows[3]["title"], rows[3]["year"]} == {None}


def test_texts_attributes_and_last_pairs(spark):
    given = {
        "tag": "<a b=\"x &amp;lt; &#38;gt; y's\" c='\"' d=bare>", "text": " a &lt;b&gt; &aring;&amp;aring; ",
        "html": "x<b> y &nbsp;</b><!-- no --><i></i>z",
    }
    row = spark.createDataFrame([tuple(given.values())], list(given)).select(
        *[sql(attribute("tag", n)).alias(n) for n in "bcde"], sql(decode_entities("text")).alias("text"),
        sql(visible_text("text")).alias("plain"), sql(visible_text("html", "|")).alias("pieces"),
        sql(visible_text("nullif(text, text)")).alias("none"),
    ).first()
    assert row.asDict() == {"b": "x &lt; > y's", "c": '"', "d": "bare", "e": None, "text": " a <b> å&aring; ", "plain": "a <b> å&aring;",
                            "pieces": "x|y|z", "none": None}
    pairs = "array(struct('k' AS label, '1' AS value), struct('k' AS label, '2' AS value), struct('m' AS label, '3' AS value))"
    last = spark.range(1).select(sql(pairs).alias("p")).select(sql(last_value("p", "k")).alias("k"), sql(last_value("p", "x")).alias("x")).first()
    assert (last["k"], last["x"]) == ("2", None)
