"""Positioned words to records: lines, columns and running section labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import zfill
from cadastra.operators.windows import carry_forward

# Column breaks and text patterns of the published award list.
COLUMN_BREAKS = (190, 370)
SECTION = "(?i)\\d+\\s+villes?\\s+“(\\d+)\\s+LAURIERS?”"
ENTRY = r"^(.+?)\s*\((\d{1,3}[AB]?)\)$"
JUNK = r"(?i)(Palmar|pouvez|labelli|depuis|internet|www\.|^Ville$|Active|Sportive|\d{4})"


def column_of(x: Column, breaks: Sequence[float]) -> Column:
    """0-based text column of a horizontal position."""
    return sum((F.when(x >= b, 1).otherwise(0) for b in breaks), F.lit(0))


def lines(
    words: DataFrame, document: str = "doc", breaks: Sequence[float] = COLUMN_BREAKS
) -> DataFrame:
    """Words ``(doc, page, x0, top, text)`` to one text per page, line and column. Positions on a
    line grow, so a column is one run of words; a line holds no more words than fit on paper."""
    return (
        words.groupBy(
            document,
            "page",
            column_of(F.col("x0"), breaks).alias("col"),
            F.bround("top", 0).cast("int").alias("y"),
        )
        .agg(F.sort_array(F.collect_list(F.struct("x0", "text"))).alias("_w"))
        .select(
            document, "page", "col", "y",
            F.array_join(F.transform("_w", lambda w: w["text"]), " ").alias("text"),
        )
    )


def labelled_entries(
    lines_: DataFrame,
    document: str = "doc",
    *,
    section: str = SECTION,
    entry: str = ENTRY,
    junk: str = JUNK,
) -> DataFrame:
    """Entries ``name (code)`` with the number of the section heading they stand under. Reading
    order is page, column, line; a heading holds until the next one, across columns and pages."""
    text = F.col("text")
    kept = lines_.filter(~text.rlike(junk))
    heading = F.when(text.rlike(section), F.regexp_extract(text, section, 1).cast("int"))
    marked = kept.withColumn("_heading", heading)
    carried = carry_forward(marked, [document], ["page", "col", "y"], "_heading", "label")
    trimmed = F.trim(text)
    return carried.filter(
        F.col("_heading").isNull() & trimmed.rlike(entry) & F.col("label").isNotNull()
    ).select(
        document,
        "page",
        F.lower(F.trim(F.regexp_extract(trimmed, entry, 1))).alias("name"),
        zfill(F.regexp_extract(trimmed, entry, 2), 2).alias("code"),
        "label",
    )
