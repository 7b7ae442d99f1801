"""HTML and XML extraction as column expressions.

The pages handled here are listings and detail cards: repeated elements with a tag and a class,
whose fields sit inside. ``blocks`` cuts a page at the tags of one kind and keeps, by counting
openings and closings, exactly the part that belongs to each element. Everything runs in the JVM;
no parser library and no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named entities met in French pages.
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'",
    "&agrave;": "à", "&acirc;": "â", "&ccedil;": "ç", "&egrave;": "è", "&eacute;": "é",
    "&ecirc;": "ê", "&euml;": "ë", "&icirc;": "î", "&iuml;": "ï", "&ocirc;": "ô",
    "&ugrave;": "ù", "&ucirc;": "û", "&oelig;": "œ", "&rsquo;": "’", "&ndash;": "–",
}


ENTITIES |= {f"&{name[1].upper()}{name[2:]}": char.upper() for name, char in ENTITIES.items() if char.isalpha()}
ENTITIES["&OElig;"] = ENTITIES.pop("&Oelig;")

VALUE = """("[^"]*"|'[^']*'|[^\\s"'>]+)"""


def open_tag(tag: str, cls: str | None = None) -> str:
    """Pattern of an opening tag, optionally with a class among its classes; letter case and the
    kind of quotes do not matter."""
    if cls is None:
        return rf"(?i)<{tag}(?![-\w])[^>]*>"
    return (
        rf"""(?i)<{tag}(?![-\w])[^>]*?(?<![-\w])class\s*=\s*"""
        rf"""(?:["'](?:[^"']*\s)?{cls}(?:\s[^"']*)?["']|{cls}(?=[\s>]))[^>]*>"""
    )


def uncommented(html: Column) -> Column:
    """HTML without its comments; an open comment reaches to the end."""
    return F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")


def unescape(text: Column) -> Column:
    """Named, decimal and hexadecimal character references to characters; numbers that are no
    character become U+FFFD. The result of a reference is not read again. Most texts have none."""
    return _let(text, lambda t: F.when(t.contains("&"), _references(t)).otherwise(t))


def _references(text: Column) -> Column:
    out = text
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))

    def decode(piece: Column) -> Column:
        code = F.substring_index(piece, ";", 1)
        is_hex = F.lower(F.substring(code, 1, 1)) == "x"
        digits = F.regexp_replace(F.regexp_replace(code, "^[xX]", ""), "^0+(?=.)", "")
        number = F.when(F.length(digits) <= 8, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)).try_cast("bigint")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        # A decoded & stays one: it is written as its name, which is replaced last.
        shown = F.when(number == 38, F.lit("&amp;")).when(valid, char).otherwise(F.lit("\ufffd"))
        return F.concat(shown, F.substr(piece, F.length(code) + 2))

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), decode)
        return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))

    out = _let(F.split(out, "&#(?=[0-9]+;|[xX][0-9a-fA-F]+;)"), joined)
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def text(html: Column) -> Column:
    """Visible text of a fragment: tags removed, entities decoded, ends trimmed."""
    return F.regexp_replace(unescape(strip_tags(html)), r"^[\s ]+|[\s ]+$", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks(html: Column, tag: str, cls: str | None = None, outer: bool = False) -> Column:
    """Every element with the tag and class, as its HTML from the opening tag up to its own
    closing tag (elements of the same kind inside it included). An element that is never closed
    reaches to the end. With ``outer`` elements inside others of the tag are left out."""

    tag_start = rf"(?i)<{tag}(?![-\w])"
    kind = lambda p: (
        F.when(p.rlike(rf"{tag_start}[^>]*/>"), 0).when(p.rlike("^" + tag_start), 1)
        .when(p.rlike(rf"(?i)^</{tag}(?![-\w])"), -1).otherwise(0)
    )

    def elements(pieces: Column) -> Column:
        marked = F.transform(pieces, lambda p, i: F.struct(i.alias("at"), kind(p).alias("kind")))
        # The n-th opening among k openings and closings has k - n closings before it, which gives
        # the depth of each without a running sum.
        events = F.transform(
            F.filter(marked, lambda e: e["kind"] != 0),
            lambda e, k: F.struct(e["at"].alias("at"), e["kind"].alias("kind"), (k + 1).alias("k")),
        )

        def levels(events: Column) -> Column:
            opened = F.transform(
                F.filter(events, lambda e: e["kind"] == 1),
                lambda e, n: F.struct((2 * n + 2 - e["k"]).alias("level"), e["at"].alias("at"), F.lit(True).alias("opens")),
            )
            closed = F.transform(
                F.filter(events, lambda e: e["kind"] == -1),
                lambda e, n: F.struct((e["k"] - 2 * n - 1).alias("level"), e["at"].alias("at"), F.lit(False).alias("opens")),
            )
            return F.array_sort(F.concat(opened, closed))

        def cut(ordered: Column) -> Column:
            # On one level openings and closings take turns, so the next one closes an opening.
            spans = F.transform(
                ordered,
                lambda e, n: F.struct(
                    e["at"].alias("at"), (e["opens"] & (e["level"] <= 1) if outer else e["opens"]).alias("opens"),
                    F.when(F.get(ordered, n + 1)["level"] == e["level"], F.get(ordered, n + 1)["at"])
                    .otherwise(F.size(pieces)).alias("end"),
                ),
            )
            wanted = F.filter(
                spans, lambda s: s["opens"] & F.element_at(pieces, s["at"] + 1).rlike("^" + open_tag(tag, cls))
            )
            return F.transform(
                F.array_sort(wanted), lambda s: F.array_join(F.slice(pieces, s["at"] + 1, s["end"] - s["at"]), "")
            )

        return _let(_let(events, levels), cut)

    return _let(F.split(uncommented(html), rf"(?i)(?=</?{tag}(?![-\w]))"), elements)


# Tags that are found inside tags of their own kind.
NESTING = {"article", "div", "li", "nav", "ol", "section", "span", "table", "tbody", "td", "tr", "ul"}


def inner(html: Column, tag: str, cls: str | None = None) -> Column:
    """Inner HTML of the first element; NULL if there is none."""
    if tag in NESTING:
        first = F.get(blocks(html, tag, cls), F.lit(0))
        return F.regexp_replace(first, "^" + open_tag(tag, cls), "")
    pattern = rf"(?s){open_tag(tag, cls)}(.*?)</{tag}\s*>"
    plain = uncommented(html)
    return F.when(plain.rlike(pattern), F.regexp_extract(plain, pattern, 1))


def first_text(html: Column, tag: str, cls: str | None = None) -> Column:
    """Text of the first element; NULL if there is none or it is blank."""
    return F.nullif(text(inner(html, tag, cls)), F.lit(""))


def all_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    pattern = rf"(?s){open_tag(tag, cls)}(.*?)</{tag}\s*>"
    return F.transform(F.regexp_extract_all(uncommented(html), F.lit(pattern), F.lit(1)), text)


def attribute(html: Column, tag: str, name: str, cls: str | None = None) -> Column:
    """An attribute of the first element; NULL if absent."""
    opening = F.regexp_extract(uncommented(html), open_tag(tag, cls), 0)
    pattern = rf"(?is)(?<![-\w]){name}\s*=\s*{VALUE}"
    return F.when(opening.rlike(pattern), unescape(_bare(F.regexp_extract(opening, pattern, 1))))


def _bare(value: Column) -> Column:
    """An attribute value without its quotes."""
    return F.regexp_replace(value, """^["']|["']$""", "")


def all_attributes(html: Column, tag: str, name: str) -> Column:
    pattern = rf"(?is)<{tag}(?![-\w])[^>]*?(?<![-\w]){name}\s*=\s*{VALUE}"
    found = F.regexp_extract_all(uncommented(html), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda v: unescape(_bare(v)))


def locations(xml: Column, needle: str = "") -> Column:
    """``<loc>`` addresses of a sitemap that contain ``needle``."""
    urls = F.regexp_extract_all(xml, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    return F.filter(F.transform(urls, unescape), lambda u: u.contains(needle))


def table_rows(html: Column, cls: str | None = None) -> Column:
    """Body rows of a table as an array of arrays of cell texts."""
    body = inner(inner(html, "table", cls), "tbody")
    cells = lambda row: F.transform(blocks(row, "td", outer=True), text)
    return F.transform(blocks(body, "tr", outer=True), cells)


def image_number(html: Column) -> Column:
    """The number in an image path (``/images/3.png`` gives 3); 0 without one."""
    digits = F.regexp_extract(attribute(html, "img", "src"), r"/(\d+)\.png$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def first_non_empty(*candidates: Column) -> Column:
    """The first array that has an element, else an empty array."""
    return F.coalesce(
        *[F.when(F.size(c) > 0, c) for c in candidates], F.array().cast("array<string>")
    )


def last_token(value: Column) -> Column:
    return F.element_at(F.split(F.trim(value), r"\s+"), -1)


def page_anchors(html: Column) -> Column:
    """Anchors of a page as structs of address and text."""
    hits = F.regexp_extract_all(uncommented(html), F.lit(r"(?is)<a(?![-\w])[^>]*>.*?</a\s*>"), F.lit(0))
    return F.transform(
        hits,
        lambda a: F.struct(attribute(a, "a", "href").alias("href"), text(a).alias("label")),
    )
