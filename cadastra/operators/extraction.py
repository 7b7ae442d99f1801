"""Records from listing and detail pages held in a page table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import html as H
from cadastra.functions.columns import not_blank, zfill
from cadastra.session import shuffle_partitions

# Kinds of destination named by a CSS class.
DESTINATION_KINDS = ["mer", "montagne", "nature", "ville"]


def dealt(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Pages dealt to shuffle partitions. Taking a page apart costs far more than moving it, and a file of
    many short pages is read by one task."""
    return pages.repartition(shuffle_partitions(pages.sparkSession), key, "html")


def destinations(pages: DataFrame) -> DataFrame:
    """Destination cards: name, department code and kind; incomplete cards are dropped."""
    card = F.col("card")
    classes = F.split(H.attribute(card, "article", "class"), r"\s+")
    kind = F.get(F.filter(classes, lambda c: c.isin(DESTINATION_KINDS)), F.lit(0))
    place = F.coalesce(H.inner(card, "p", "col-4"), H.inner(card, "p", "align-self-center"))
    code = F.regexp_extract(H.text(place), r"\((\d+|2A|2B)\)", 1)
    name = H.first_text(H.inner(card, "h5"), "a")
    return (
        dealt(pages).select("page_id", F.explode(H.blocks(F.col("html"), "article", "node--type-destination")).alias("card"))
        .select("page_id", name.alias("name"), F.nullif(code, F.lit("")).alias("department_code"), kind.alias("type"))
        .filter("name is not null and department_code is not null and type is not null")
    )


def sitemap(pages: DataFrame, needle: str) -> DataFrame:
    return pages.select("page_id", F.explode(H.locations(F.col("html"), needle)).alias("url"))


def city_pages(pages: DataFrame) -> DataFrame:
    """Title and department of a detail page; the department stands after the first comma."""
    html = F.col("html")
    place = H.first_text(html, "div", "location")
    after = F.when(place.contains(","), F.split_part(place, F.lit(","), F.lit(2))).otherwise(place)
    return dealt(pages).select(
        "page_id",
        F.lower(H.first_text(html, "h1", "cover-title")).alias("city"),
        F.nullif(F.lower(F.trim(after)), F.lit("")).alias("department"),
    ).filter("city is not null and department is not null")


def villages(pages: DataFrame) -> DataFrame:
    """Listing entries with a name and a locality whose last word is the department."""
    card = F.col("card")
    return (
        dealt(pages).select("page_id", F.explode(H.blocks(F.col("html"), "div", "result")).alias("card"))
        .select(
            "page_id",
            F.lower(H.first_text(card, "div", "name")).alias("city"),
            H.last_token(F.lower(H.first_text(card, "div", "locality"))).alias("department"),
        )
        .filter(not_blank(F.col("city")) & not_blank(F.col("department")))
    )


def labelled_towns(pages: DataFrame, cls: str = "ea-advanced-data-table") -> DataFrame:
    """Second and fifth cell of each table row that has them."""
    cells = F.col("cells")
    return (
        dealt(pages).select("page_id", F.explode(H.table_rows(F.col("html"), cls)).alias("cells"))
        .filter(F.size(cells) >= 5)
        .select(
            "page_id",
            F.lower(F.element_at(cells, 2)).alias("city"),
            zfill(F.element_at(cells, 5), 2).alias("department"),
        )
        .filter(not_blank(F.col("city")) & not_blank(F.col("department")))
    )


def flower_rows(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """API rows of HTML cells: name, region, department and the number in the image path."""
    cell = lambda i: F.element_at(F.col(cells), i)
    return rows.select(
        F.lower(H.text(cell(1))).alias("commune"),
        F.lower(H.text(cell(2))).alias("region"),
        F.lower(H.text(cell(3))).alias("departement"),
        H.image_number(cell(5)).alias("nb_fleurs"),
    )


def listing_urls(html: Column) -> Column:
    """Detail addresses of a listing page by the first of three layouts that yields any."""
    attribute = H.all_attributes(html, r"\w+", "data-ha-element-link")
    from_json = F.filter(
        F.transform(attribute, lambda a: F.get_json_object(a, "$.url")), lambda u: u.isNotNull()
    )
    items = F.transform(H.blocks(html, "div", "e-loop-item"), lambda b: H.attribute(b, "a", "href"))
    from_items = F.filter(items, lambda u: u.contains("/village-etape/"))
    wrapped = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?s)<a\b[^>]*>(?:(?!</a>).)*</a>"), F.lit(0)),
        lambda a: a.rlike(H.open_tag("h2", "elementor-heading-title")),
    )
    from_headings = F.filter(
        F.transform(wrapped, lambda a: H.attribute(a, "a", "href")), lambda u: u.isNotNull()
    )
    return H.first_non_empty(from_json, from_items, from_headings)


def has_next_page(html: Column, page: Column, last: int) -> Column:
    """By the pagination bar if there is one, else by the known number of pages, ``last``."""
    bar = H.inner(html, "nav", "elementor-pagination")
    return F.when(bar.isNotNull(), bar.rlike(H.open_tag("a", "next"))).otherwise(page < last)


def village_pages(pages: DataFrame) -> DataFrame:
    """Detail pages to one record with a JSON text of the contact lines."""
    html = F.col("html")
    name = F.coalesce(H.first_text(html, "h1", "elementor-heading-title"), H.first_text(html, "h1"))
    first_list = F.regexp_extract(html, H.open_tag("ul", "elementor-icon-list-items"), 0)
    inline = first_list.rlike("elementor-inline-items")
    facts = H.all_texts(H.inner(html, "ul", "elementor-icon-list-items"), "span", "elementor-icon-list-text")
    fact = lambda i: F.when(inline, F.get(facts, F.lit(i)))

    sections = H.blocks(html, "div", "elementor-icon-list-items")
    contacts = F.flatten(
        F.transform(sections, lambda s: H.all_texts(s, "span", "elementor-icon-list-text"))
    )
    hall = lambda t: F.lower(t).contains("mairie")
    office = lambda t: ~hall(t) & F.lower(t).contains("tourisme")
    mail = lambda t: ~hall(t) & ~F.lower(t).contains("tourisme") & t.contains("@")
    last = lambda test: F.get(F.reverse(F.filter(contacts, test)), F.lit(0))
    practical = F.struct(
        last(hall).alias("mairie"), last(office).alias("tourist_office"), last(mail).alias("email")
    )
    return dealt(pages, "url").select(
        name.alias("name"),
        "url",
        fact(0).alias("region"),
        fact(1).alias("road"),
        H.first_text(H.inner(html, "div", "elementor-widget-text-editor"), "p").alias("description"),
        F.nullif(F.to_json(practical), F.lit("{}")).alias("practical"),
    ).filter("name is not null")
