"""The calendar and its enrichment tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import dates as D
from cadastra.functions.columns import date_key, round_exact
from cadastra.operators.joins import interval_join
from cadastra.operators.sets import membership

FIRST_DAY = "1900-01-01"
LAST_DAY = "2100-12-31"


def days(spark: SparkSession, first: str | Column = FIRST_DAY, last: str | Column = LAST_DAY) -> DataFrame:
    start = F.lit(first).cast("date") if isinstance(first, str) else first
    end = F.lit(last).cast("date") if isinstance(last, str) else last
    return spark.range(1).select(F.explode(F.sequence(start, end)).alias("date"))


def part_columns(d: Column) -> list[Column]:
    return [
        date_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        D.year_month(d).alias("year_month"),
        F.weekofyear(d).alias("iso_week"),
        D.iso_weekday(d).alias("iso_day_of_week"),
        D.day_name(d, "fr").alias("day_name_fr"),
        D.month_name(d, "fr").alias("month_name_fr"),
        D.day_name(d, "en").alias("day_name_en"),
        D.month_name(d, "en").alias("month_name_en"),
        D.is_weekend(d).alias("is_weekend"),
    ]


def calendar_parts(df: DataFrame) -> DataFrame:
    """Date parts and names for a ``date`` column."""
    return df.select(*part_columns(F.col("date")))


def christian_holidays(years: DataFrame) -> DataFrame:
    """Feast dates of each ``year``."""
    return years.select(F.explode(D.christian_feasts(F.col("year"))).alias("date")).distinct()


def religious_holidays(sets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per observed date with a flag per tradition; ``sets`` maps ``christian`` etc. to
    date tables."""
    return membership({f"is_{name}_holiday": df for name, df in sets.items()}, "date")


def market_holidays(calendar: DataFrame, sessions: DataFrame, public: DataFrame) -> DataFrame:
    """Weekdays without trading. Inside the range of the published sessions a day without a
    session is closed; outside it only public holidays are."""
    span = sessions.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    low, high = span.select("lo").scalar(), span.select("hi").scalar()
    flagged = (
        calendar.select("date")
        .join(sessions.select("date", F.lit(True).alias("_s")).distinct(), "date", "left")
        .join(public.select("date", F.lit(True).alias("_h")).distinct(), "date", "left")
    )
    session = F.when(F.col("date").between(low, high), F.coalesce("_s", F.lit(False)))
    return flagged.filter(D.market_closed(F.col("date"), session, F.col("_h"))).select(
        "date", F.lit(True).alias("is_market_holiday")
    )


def lunar_phases(phases: DataFrame) -> DataFrame:
    """Daily phase values (0-28) to names, illumination and lunation number."""
    phase = F.col("phase")
    name = D.moon_phase_name(phase)
    return phases.select(
        "date",
        round_exact(phase, 2).alias("moon_phase_value"),
        name.alias("moon_phase_name"),
        D.moon_illumination(phase).alias("moon_illumination_fraction"),
        (name == "Full Moon").alias("is_full_moon"),
        (name == "New Moon").alias("is_new_moon"),
        D.lunation(F.col("date")).alias("lunar_cycle_id"),
    )


def dim_calendar(
    calendar: DataFrame,
    public: DataFrame,
    market: DataFrame,
    religious: DataFrame,
    terms: Mapping[str, DataFrame],
    moon: DataFrame,
) -> DataFrame:
    """Calendar days with holidays, terms of office and the moon; what is unknown gets a default.
    ``terms`` maps an output column (``president`` …) to its interval table."""
    flags = [c for c in religious.columns if c != "date"]
    on_day = lambda df: df.withColumn("date", F.col("date").cast("date"))
    # Terms are joined to the bare days first, where the plan is still short.
    days_ = calendar.select("date")
    for column, intervals in terms.items():
        named = intervals.select("start_date", "end_date", F.col("name").alias(column))
        days_ = interval_join(days_, named, "date", [column], spread=["date"], sketch=calendar)
    out = (
        days_
        .join(on_day(public).select("date", "holiday_name", F.col("is_public_holiday").cast("boolean").alias("_p")), "date", "left")
        .join(on_day(market).select("date", F.col("is_market_holiday").cast("boolean").alias("_m")), "date", "left")
        .join(on_day(religious), "date", "left")
        .join(on_day(moon), "date", "left")
    )
    no = F.lit(False)
    return out.select(
        *part_columns(F.col("date")),
        F.coalesce("_p", no).alias("is_public_holiday"),
        F.coalesce("holiday_name", F.lit("")).alias("fete"),
        F.coalesce("_m", no).alias("is_market_holiday"),
        *[F.coalesce(F.col(f).cast("boolean"), no).alias(f) for f in flags],
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in terms],
        F.coalesce(F.col("moon_phase_value").cast("double"), F.lit(0.0)).alias("moon_phase_value"),
        F.coalesce("moon_phase_name", F.lit("")).alias("moon_phase_name"),
        F.coalesce(F.col("moon_illumination_fraction").cast("double"), F.lit(0.0)).alias(
            "moon_illumination_fraction"
        ),
        F.coalesce(F.col("is_full_moon").cast("boolean"), no).alias("is_full_moon"),
        F.coalesce(F.col("is_new_moon").cast("boolean"), no).alias("is_new_moon"),
        F.coalesce(F.col("lunar_cycle_id").cast("int"), F.lit(0)).alias("lunar_cycle_id"),
    )


TIMELINE_TYPE = "map<string,array<struct<name:string,start:string,end:string>>>"


def timelines(nested: DataFrame, column: str = "timelines") -> DataFrame:
    """Nested lists of terms to rows ``(category, start_date, end_date, name)``; entries that
    break a rule are left to ``timeline_violations``."""
    return _timeline_rows(nested, column).filter("problem is null").select(
        "category",
        F.to_date("start").alias("start_date"),
        F.to_date("end").alias("end_date"),
        "name",
    )


def timeline_violations(nested: DataFrame, column: str = "timelines") -> DataFrame:
    return _timeline_rows(nested, column).filter("problem is not null").select(
        "category", "name", "start", "end", "problem"
    )


def _timeline_rows(nested: DataFrame, column: str) -> DataFrame:
    iso = lambda c: F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(F.col(c)).isNotNull()
    problem = (
        F.when(F.coalesce("name", F.lit("")) == "", "name missing")
        .when(F.col("start").isNull(), "start missing")
        .when(~iso("start"), "start not ISO")
        .when(F.col("end").isNotNull() & ~iso("end"), "end not ISO")
    )
    return (
        nested.select(F.explode(column).alias("category", "entries"))
        .select("category", F.inline("entries"))
        .withColumn("problem", problem)
    )
