"""HTML extraction and positioned words."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import html as X
from cadastra.operators import extraction as E
from cadastra.operators import layout as L
from cadastra.queries.registry import Tables, query

UNESCAPE = "replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query("page_headings", f"""
SELECT page_id, trim(lower({UNESCAPE.format("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")})) AS city,
 trim({UNESCAPE.format("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")}) AS title FROM pages""")
def page_headings(t: Tables):
    """H3, H8: heading and title texts of whole pages, entities decoded."""
    return t.pages.select(
        "page_id", F.lower(X.first_text(F.col("html"), "h1")).alias("city"), X.first_text(F.col("html"), "title").alias("title")
    )


@query("page_links", f"""
SELECT page_id, u.href AS href, {UNESCAPE.format("u.label")} AS label FROM (
 SELECT page_id, unnest(list_zip(regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 1), regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 2))) AS z FROM pages) q,
 LATERAL (SELECT {UNESCAPE.format("z[1]")} AS href, z[2] AS label) u""")
def page_links(t: Tables):
    """H6: address and text of every anchor of every page."""
    anchors = t.pages.select("page_id", F.explode(X.page_anchors(F.col("html"))).alias("a"))
    return anchors.select("page_id", F.col("a.href").alias("href"), F.col("a.label").alias("label"))


@query("page_list_items", f"""
SELECT page_id, i, {UNESCAPE.format("regexp_replace(item, '<[^>]+>', '', 'g')")} AS item FROM (
 SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages))""")
def page_list_items(t: Tables):
    """H1: repeated elements, one row each, in page order."""
    items = t.pages.select("page_id", F.posexplode(X.blocks(F.col("html"), "li")).alias("i", "block"))
    return items.select("page_id", F.col("i").cast("bigint").alias("i"), X.text(X.inner(F.col("block"), "li")).alias("item"))


@query("page_text_sizes", f"""
SELECT page_id, CAST(length(trim({UNESCAPE.format("regexp_replace(html, '<[^>]+>', '', 'g')")}, chr(10) || ' ' || chr(9) || chr(13))) AS INTEGER) AS n_chars, regexp_matches(html, '<div[^>]*class="ad"') AS has_ad FROM pages""")
def page_text_sizes(t: Tables):
    """H8: visible text of whole pages."""
    html = F.col("html")
    return t.pages.select("page_id", F.length(X.text(html)).alias("n_chars"), html.rlike(X.open_tag("div", "ad")).alias("has_ad"))


def cards(t: Tables):
    """One listing page per supplier with two destination cards, the second incomplete for some
    nations."""
    name, nation = F.col("s_name"), F.col("s_nationkey")
    kind = F.when(nation < 8, "mer").when(nation < 16, "montagne").otherwise("lac")
    code = F.when(nation == 0, "2A").otherwise(F.lpad(nation.cast("string"), 2, "0"))
    card = lambda title, place: F.concat(
        F.lit('<article class="node node--type-destination '), kind, F.lit('" id="x"><div><h5><a href="/d"> '), title,
        F.lit(' </a></h5><p class="col-4 small">Zone <b>('), place, F.lit(")</b></p></div></article>"),
    )
    first = card(F.concat(name, F.lit(" &amp; Fils")), code)
    second = card(F.lower(name), F.when(nation % 2 == 0, "??").otherwise(F.lit("971")))
    return t.supplier.select(F.col("s_suppkey").alias("page_id"), F.concat(F.lit("<html><body>"), first, second, F.lit("</body></html>")).alias("html"))


@query("destination_cards", """
WITH s AS (SELECT *, CASE WHEN s_nationkey < 8 THEN 'mer' WHEN s_nationkey < 16 THEN 'montagne' END AS kind FROM supplier)
SELECT s_suppkey AS page_id, s_name || ' & Fils' AS name, CASE WHEN s_nationkey = 0 THEN '2A' ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS department_code, kind AS type FROM s WHERE kind IS NOT NULL
UNION ALL SELECT s_suppkey, lower(s_name), '971', kind FROM s WHERE kind IS NOT NULL AND s_nationkey % 2 = 1""")
def destination_cards(t: Tables):
    """H1: cards by tag and class; kind from the class list; incomplete cards dropped."""
    return E.destinations(cards(t))


@query("sitemap_urls", """
SELECT c_custkey AS page_id, 'https://x/cites/' || c_name || '&a' AS url FROM customer""")
def sitemap_urls(t: Tables):
    """H2: addresses of a sitemap that contain a path."""
    xml = F.concat(F.lit("<urlset><url><loc>https://x/cites/"), "c_name", F.lit("&amp;a</loc></url><url><loc>\n https://x/blog/1</loc></url></urlset>"))
    return E.sitemap(t.customer.select(F.col("c_custkey").alias("page_id"), xml.alias("html")), "/cites/")


@query("detail_pages", """
SELECT s_suppkey AS page_id, lower(s_name) AS city, CASE WHEN s_nationkey < 10 THEN 'dep ' || s_nationkey ELSE 'region ' || s_nationkey END AS department FROM supplier WHERE s_nationkey < 20""")
def detail_pages(t: Tables):
    """H3: title and the text after the first comma; incomplete pages dropped."""
    nation = F.col("s_nationkey")
    place = F.when(nation < 10, F.concat(F.lit("Somewhere, Dep "), nation.cast("string"), F.lit(", x"))).otherwise(F.concat(F.lit("Region "), nation.cast("string")))
    box = F.when(nation < 20, F.concat(F.lit('<div class="location"><i></i> '), place, F.lit(" </div>"))).otherwise("")
    html = F.concat(F.lit("<h1 class='big cover-title'>\n"), "s_name", F.lit("</h1>"), box)
    return E.city_pages(t.supplier.select(F.col("s_suppkey").alias("page_id"), html.alias("html")))


@query("village_listing", """
SELECT s_suppkey AS page_id, lower(s_name) AS city, CAST(s_nationkey AS VARCHAR) AS department FROM supplier
UNION ALL SELECT s_suppkey, 'second', 'dep' FROM supplier WHERE s_nationkey > 5""")
def village_listing(t: Tables):
    """H4: nested listing entries; the last word of the locality is the department."""
    nation = F.col("s_nationkey").cast("string")
    entry = lambda a, b: F.concat(
        F.lit('<div class="result first"><div class="name"> '), a, F.lit('</div><div class="locality">'), b, F.lit("</div></div>")
    )
    second = F.when(F.col("s_nationkey") > 5, entry(F.lit("Second"), F.lit("Some  DEP"))).otherwise('<div class="result"><div class="name">No place</div></div>')
    html = F.concat(F.lit("<div class='results'>"), entry(F.col("s_name"), F.concat(F.lit("Region\n"), nation)), second, F.lit("</div>"))
    return E.villages(t.supplier.select(F.col("s_suppkey").alias("page_id"), html.alias("html")))


@query("table_rows", """
SELECT c_custkey AS page_id, lower(c_name) AS city, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS department FROM customer
UNION ALL SELECT c_custkey, 'b', '2A' FROM customer""")
def table_rows(t: Tables):
    """Body rows with five cells, numeric codes padded."""
    row = lambda *c: F.concat(F.lit("<tr>"), *[F.concat(F.lit('<td class="x">'), v, F.lit("</td>")) for v in c], F.lit("</tr>"))
    e = F.lit("-")
    body = F.concat(
        row(e, F.col("c_name"), e, e, F.col("c_nationkey").cast("string")), row(e, F.lit("<a>B</a>"), e, e, F.lit("2A")), row(e, F.lit("short")),
    )
    html = F.concat(F.lit('<table class="ea-advanced-data-table big"><thead><tr><th>h</th></tr></thead><tbody>'), body, F.lit("</tbody></table>"))
    return E.labelled_towns(t.customer.select(F.col("c_custkey").alias("page_id"), html.alias("html")))


@query("flower_rows", """
SELECT lower(c_name) AS commune, 'île & co' AS region, lower(c_mktsegment) AS departement, CAST(CASE WHEN c_nationkey < 5 THEN c_nationkey ELSE 0 END AS INTEGER) AS nb_fleurs FROM customer""")
def flower_rows(t: Tables):
    """H8: cells to lower-case texts, number from the image path."""
    image = F.when(F.col("c_nationkey") < 5, F.concat(F.lit('<img alt="" src="/images/'), F.col("c_nationkey").cast("string"), F.lit('.png">'))).otherwise("<img src='/images/none.gif'>")
    cells = F.array(F.concat(F.lit("<b>"), "c_name", F.lit("</b>")), F.lit(" &Icirc;le &amp; co".replace("&Icirc;", "&#206;")), F.col("c_mktsegment"), F.lit(""), image)
    return E.flower_rows(t.customer.select(cells.alias("cells")))


@query("listing_strategies", """
SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 0 THEN 'json|json2' WHEN 1 THEN '/village-etape/' || c_name WHEN 2 THEN '/h/' || c_name ELSE '' END AS urls,
 CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 4 = 0 ELSE c_custkey < 4 END AS more FROM customer""")
def listing_strategies(t: Tables):
    """First of three page layouts that yields addresses; next-page test."""
    n = F.col("c_custkey")
    name = F.col("c_name")
    json = '<div data-ha-element-link=\'{"url": "json"}\'></div><div data-ha-element-link="{broken"></div><p data-ha-element-link="{&quot;url&quot;: &quot;json2&quot;}"></p>'
    items = F.concat(F.lit('<div class="e-loop-item"><a class="k" href="/village-etape/'), name, F.lit('">x</a></div><div class="e-loop-item"><a href="/other">y</a></div>'))
    heads = F.concat(F.lit('<a href="/no"><h3>n</h3></a><a href="/h/'), name, F.lit('"><h2 class="elementor-heading-title">t</h2></a>'))
    layout = F.when(n % 4 == 0, F.concat(F.lit(json), items)).when(n % 4 == 1, F.concat(items, heads)).when(n % 4 == 2, heads).otherwise("<p></p>")
    bar = F.when(n % 2 == 0, F.concat(F.lit('<nav class="elementor-pagination"><a class="'), F.when(n % 4 == 0, "page next").otherwise("page"), F.lit('" href="#">1</a></nav>'))).otherwise("")
    pages = t.customer.select(n.alias("page_id"), F.concat(layout, bar).alias("html"))
    return pages.select("page_id", F.array_join(E.listing_urls(F.col("html")), "|").alias("urls"), E.has_next_page(F.col("html"), F.col("page_id"), 4).alias("more"))


@query("village_records", """
SELECT s_name AS name, '/v/' || s_suppkey AS url, CASE WHEN s_nationkey < 12 THEN 'Région ' || s_nationkey END AS region, CASE WHEN s_nationkey < 6 THEN 'N ' || s_nationkey END AS road,
 CASE WHEN s_nationkey < 20 THEN 'About ' || s_name END AS description,
 CASE WHEN s_nationkey < 6 THEN '{"mairie":"Mairie : 01","email":"a@b.fr"}' WHEN s_nationkey < 12 THEN '{"tourist_office":"Office de Tourisme"}' END AS practical FROM supplier""")
def village_records(t: Tables):
    """Detail pages to records with a JSON text of classified contact lines."""
    n = F.col("s_nationkey")
    item = lambda v: F.concat(F.lit('<li class="elementor-icon-list-item"><span class="elementor-icon-list-text"> '), v, F.lit("</span></li>"))
    road = F.when(n < 6, item(F.concat(F.lit("N "), n.cast("string")))).otherwise("")
    facts = F.when(
        n < 12, F.concat(F.lit('<ul class="elementor-icon-list-items elementor-inline-items">'), item(F.concat(F.lit("R&eacute;gion "), n.cast("string"))), road, F.lit("</ul>"))
    ).otherwise(F.concat(F.lit('<ul class="elementor-icon-list-items">'), item(F.lit("x")), F.lit("</ul>")))
    about = F.when(n < 20, F.concat(F.lit('<div class="elementor-widget-text-editor"><p>About '), "s_name", F.lit("</p><p>more</p></div>"))).otherwise("")
    lines = F.when(n < 6, F.concat(item(F.lit("Mairie : 01")), item(F.lit("a@b.fr")))).when(n < 12, item(F.lit("Office de Tourisme"))).otherwise(item(F.lit("other")))
    html = F.concat(F.lit('<h1 class="elementor-heading-title">'), "s_name", F.lit("</h1>"), facts, about, F.lit('<div class="elementor-icon-list-items">'), lines, F.lit("</div>"))
    return E.village_pages(t.supplier.select(F.concat(F.lit("/v/"), F.col("s_suppkey").cast("string")).alias("url"), html.alias("html")))


@query("positioned_words", """
WITH o AS (SELECT o_custkey AS doc, CAST(year(o_orderdate) AS INTEGER) AS page, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS col, o_orderkey AS y,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey % 4 + 1 AS INTEGER) END AS head, o_orderpriority AS p, lpad(CAST(o_custkey % 95 AS VARCHAR), 2, '0') AS dep FROM orders),
f AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page, col, y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM o WHERE p <> '5-LOW')
SELECT doc, page, 'st ' || lower(p) AS name, dep AS code, label FROM f WHERE head IS NULL AND label IS NOT NULL""")
def positioned_words(t: Tables):
    """Words to lines, columns and entries under running section headings."""
    words = t.orders.select(
        F.col("o_custkey").alias("doc"), F.year("o_orderdate").alias("page"), F.col("o_orderkey").cast("double").alias("y"),
        F.when(F.col("o_orderstatus") == "F", 10).when(F.col("o_orderstatus") == "O", 190).otherwise(400).alias("x"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("12 villes “"), (F.col("o_orderkey") % 4 + 1).cast("string"), F.lit(" LAURIERS”")))
        .when(F.col("o_orderpriority") == "5-LOW", "Palmarès du jury")
        .otherwise(F.concat(F.lit("St "), "o_orderpriority", F.lit(" ("), (F.col("o_custkey") % 95).cast("string"), F.lit(")"))).alias("line"),
    )
    tokens = words.select("doc", "page", "x", "y", F.posexplode(F.split("line", " ")).alias("i", "text"))
    placed = tokens.select("doc", "page", (F.col("x") + F.col("i") * 5).cast("double").alias("x0"), (F.col("y") + 0.2).alias("top"), "text")
    return L.labelled_entries(L.lines(placed))
