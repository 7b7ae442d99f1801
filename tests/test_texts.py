"""Extraction on small pages, layout on small word lists."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cadastra.functions import html as X
from cadastra.operators import extraction as E
from cadastra.operators import layout as L


def pages(spark, *html):
    return spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "page_id int, url string, html string")


def test_entities(spark):
    df = spark.createDataFrame([("<p>a&amp;b &lt;i&gt; &#233;&#x2019; &eacute;&nbsp;</p> ",)], "h string")
    assert df.select(X.text(F.col("h"))).first()[0] == "a&b <i> é’ é"


def test_blocks_follow_nesting(spark):
    html = '<div class="r"><div class="r x">in</div>a</div><div>out</div><div class="r">open <b>end'
    got = pages(spark, html, "").select(X.blocks(F.col("html"), "div", "r").alias("b"), X.inner(F.col("html"), "div", "r").alias("i")).collect()
    assert got[0]["b"] == ['<div class="r"><div class="r x">in</div>a', '<div class="r x">in', '<div class="r">open <b>end']
    assert got[0]["i"] == '<div class="r x">in</div>a' and got[1]["b"] == [] and got[1]["i"] is None


def test_destinations(spark):
    card = '<article class="node node--type-destination {kind}"><h5><a href="#">{name}</a></h5><p class="{cls}">Dep ({code})</p></article>'
    html = (
        card.format(kind="mer", name="Royan", cls="col-4", code="17")
        + card.format(kind="montagne", name="Corte", cls="align-self-center", code="2B")
        + card.format(kind="autre", name="X", cls="col-4", code="01")
        + card.format(kind="ville", name="Y", cls="other", code="01")
        + '<article class="node--type-destination mer"><p class="col-4">(01)</p></article>'
        + '<article class="other mer"><h5><a>Z</a></h5><p class="col-4">(01)</p></article>'
    )
    got = [(r["name"], r["department_code"], r["type"]) for r in E.destinations(pages(spark, html, "")).collect()]
    assert got == [("Royan", "17", "mer"), ("Corte", "2B", "montagne")]


def test_city_page(spark):
    html = '<h1 class="cover-title"> Ars-en-Ré </h1><div class="location"><span>France</span>, Charente-Maritime </div>'
    alone = '<h1 class="cover-title">A</h1><div class="location">Aude</div>'
    rows = E.city_pages(pages(spark, html, alone, "<h1>none</h1>")).orderBy("page_id").collect()
    assert [(r["city"], r["department"]) for r in rows] == [("ars-en-ré", "charente-maritime"), ("a", "aude")]


def test_sitemap(spark):
    xml = "<urlset><url><loc>https://x/cites/a</loc></url><url><loc>https://x/other</loc></url></urlset>"
    assert [r["url"] for r in E.sitemap(pages(spark, xml), "/cites/").collect()] == ["https://x/cites/a"]


def test_table(spark):
    row = "<tr>" + "".join(f"<td>{c}</td>" for c in ["", "Ville", "", "", "{}"]) + "</tr>"
    html = '<table class="ea-advanced-data-table"><tbody>' + row.format("1") + row.format("2A") + "<tr><td>x</td></tr>" + row.format("") + "</tbody></table>"
    got = [(r["city"], r["department"]) for r in E.labelled_towns(pages(spark, html, "<table></table>")).collect()]
    assert got == [("ville", "01"), ("ville", "2A")]


def test_flowers(spark):
    cells = ["<b>Nice</b>", "PACA", "Alpes", "", '<img src="/images/4.png">']
    df = spark.createDataFrame([(cells,), (cells[:4] + ["none"],)], "cells array<string>")
    assert [tuple(r) for r in E.flower_rows(df).collect()] == [("nice", "paca", "alpes", 4), ("nice", "paca", "alpes", 0)]


def test_listing_strategies(spark):
    a = '<div data-ha-element-link=\'{"url": "/a"}\'></div><p data-ha-element-link="bad"></p>'
    b = '<div class="e-loop-item"><a href="/village-etape/b">x</a></div><div class="e-loop-item"><a href="/no">x</a></div>'
    c = '<a href="/c"><h2 class="elementor-heading-title">t</h2></a>'
    got = pages(spark, a + b, b + c, c, "").select("page_id", E.listing_urls(F.col("html")).alias("u")).orderBy("page_id").collect()
    assert [r["u"] for r in got] == [["/a"], ["/village-etape/b"], ["/c"], []]


def test_pagination(spark):
    bar = '<nav class="elementor-pagination"><a class="{}">x</a></nav>'
    df = pages(spark, bar.format("next page-numbers"), bar.format("prev"), "")
    got = df.select(E.has_next_page(F.col("html"), F.lit(4), 4).alias("a"), E.has_next_page(F.col("html"), F.lit(1), 4).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [(True, True), (False, False), (False, True)]


def test_village_page(spark):
    li = '<li class="elementor-icon-list-item"><span class="elementor-icon-list-text">{}</span></li>'
    html = (
        '<h1 class="elementor-heading-title">Aubigny</h1><ul class="elementor-icon-list-items elementor-inline-items">'
        + li.format("Centre") + li.format("RN 10") + "</ul>"
        '<div class="elementor-widget-text-editor"><p>Un <b>beau</b> village</p></div>'
        '<div class="elementor-icon-list-items">' + li.format("Mairie : 02") + li.format("Office de tourisme") + li.format("a@b.fr") + "</div>"
        "<footer>" + li.format("Mairie du pied de page") + "</footer>"
    )
    rows = E.village_pages(pages(spark, html, "<h1>Solo</h1>", "<p></p>")).orderBy("url").collect()
    first = rows[0]
    assert (first["name"], first["region"], first["road"], first["description"]) == ("Aubigny", "Centre", "RN 10", "Un beau village")
    assert json.loads(first["practical"]) == {"mairie": "Mairie : 02", "tourist_office": "Office de tourisme", "email": "a@b.fr"}
    assert (rows[1]["name"], rows[1]["region"], rows[1]["practical"], len(rows)) == ("Solo", None, None, 2)


def test_positioned_words(spark):
    rows = [
        ("d", 0, 10.0, 5.2, "3"), ("d", 0, 20.0, 5.1, "villes"), ("d", 0, 30.0, 4.9, "“4"), ("d", 0, 40.0, 5.0, "LAURIERS”"),
        ("d", 0, 10.0, 20.0, "Nice"), ("d", 0, 50.0, 20.3, "(06)"), ("d", 0, 200.0, 20.0, "Ajaccio"), ("d", 0, 260.0, 20.0, "(2A)"),
        ("d", 0, 400.0, 20.0, "1"), ("d", 0, 420.0, 20.0, "ville"), ("d", 0, 440.0, 20.0, "“2"), ("d", 0, 460.0, 20.0, "LAURIER”"),
        ("d", 0, 400.0, 40.0, "Bourg"), ("d", 0, 430.0, 40.0, "(1)"), ("d", 0, 10.0, 60.0, "Palmarès"), ("d", 0, 10.0, 80.0, "nothing"),
        ("d", 1, 10.0, 5.0, "Lyon"), ("d", 1, 40.0, 5.0, "(69)"), ("e", 0, 10.0, 5.0, "Orphan"), ("e", 0, 40.0, 5.0, "(01)"),
    ]
    words = spark.createDataFrame(rows, "doc string, page int, x0 double, top double, text string")
    got = sorted((r["name"], r["code"], r["label"]) for r in L.labelled_entries(L.lines(words)).collect())
    assert got == [("ajaccio", "2A", 4), ("bourg", "01", 2), ("lyon", "69", 2), ("nice", "06", 4)]


def test_anchors_of_real_pages(spark):
    page = (
        '<A HREF="/up">Up</A> <a data-href="X" href="Y">two</a> <a href=/v >three</a><a class=k href=\'/q?a=1&amp;b=2\'>four</a>'
        '<!-- <a href="/hidden">no</a> --><abbr href="/abbr">x</abbr><a name="n">five</a><!-- open <a href="/late">late</a>'
    )
    df = spark.createDataFrame([(page,)], "html string")
    row = df.select(X.page_anchors(F.col("html")).alias("a"), X.all_attributes(F.col("html"), "a", "href").alias("h")).first()
    assert [(a["href"], a["label"]) for a in row["a"]] == [
        ("/up", "Up"), ("Y", "two"), ("/v", "three"), ("/q?a=1&b=2", "four"), (None, "five")
    ]
    assert row["h"] == ["/up", "Y", "/v", "/q?a=1&b=2"]


@pytest.mark.parametrize("given, want", [
    ("&#128512;&#x1F600;", "😀😀"), ("&#99999;", chr(99999)), ("&Eacute;t&eacute;", "Été"), ("&#0000233;", "é"),
    ("&#38;lt;", "&lt;"), ("&amp;#65;", "&#65;"), ("&amp;lt;", "&lt;"), ("&#xD800;&#1114112;&#99999999999;", "���"), ("&OElig;&oelig;", "Œœ"), ("", ""),
])
def test_character_references(spark, given, want):
    assert spark.createDataFrame([(given,)], "t string").select(X.unescape(F.col("t"))).first()[0] == want


def test_elements_are_cut_in_linear_time(spark):
    import time

    def page(n):
        return "</div>" + "".join(f"<div class='card'>{i}<div>in</div></div><DIV/>" for i in range(n)) + "<div class=card>open"

    took = []
    for n in (2500, 10000):
        df = spark.createDataFrame([(page(n),)], "h string")
        start = time.perf_counter()
        cards = df.select(X.blocks(F.col("h"), "div", "card")).first()[0]
        took.append(time.perf_counter() - start)
        assert len(cards) == n + 1 and cards[7] == "<div class='card'>7<div>in</div>" and cards[-1] == "<div class=card>open"
    assert took[1] < 8 * took[0] + 3


def test_table_rows_with_a_table_inside_a_cell(spark):
    page = (
        "<TABLE class='t'><tbody><tr><td>a</td><td>b <table><tbody><tr><td>c</td></tr></tbody></table></td></tr>"
        "<tr class='x'><td>d &amp; e</td><TD>f</TD></tr></tbody></TABLE>"
    )
    row = spark.createDataFrame([(page,)], "h string").select(X.table_rows(F.col("h"), "t")).first()[0]
    assert row == [["a", "b c"], ["d & e", "f"]]
