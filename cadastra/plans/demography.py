"""Population, salaries, unemployment and income."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import (
    crosswalk, enforce, harmonize, number, prefixed, ratio, tiers_from, total_or_parts, year_key,
)
from cadastra.operators.aggregates import dedupe_first, long_to_wide, pivot_when
from cadastra.operators.joins import last_wins, prior_period
from cadastra.operators.sets import union_all
from cadastra.plans import constants as K
from cadastra.session import shuffle_partitions

def _whole(value: str) -> Column:
    """Whole number from text, half up."""
    return F.round(F.col(value).cast("decimal(38,6)"), 0).cast("int").cast("double")


def _part(
    df: DataFrame, name: str, key: str, year: Column, value: Column,
    first: str | None = None, second: str | None = None,
) -> DataFrame:
    """Rows of one source in the common shape ``(id, year, part, first, second, value)``."""
    text = lambda c: (F.col(c) if c else F.lit(None)).cast("string")
    return df.select(
        F.col(key).alias("id"), year.cast("int").alias("year"), F.lit(name).alias("part"),
        text(first).alias("first"), text(second).alias("second"), value.cast("double").alias("value"),
    )


def fact_population(
    populations: DataFrame,
    overseas: DataFrame,
    births: DataFrame,
    deaths: DataFrame,
    family: DataFrame,
    migration: DataFrame,
) -> DataFrame:
    """Population with its change to the year before, births, deaths, families and migration.

    All sources are stacked in one narrow shape and folded by (commune, year) in one conditional
    aggregate, combined on the map side, instead of a key spine with a join per source. The sources
    are dealt to tasks of their own first: stacked as they come, each would be worked off by the few
    tasks that adaptive execution leaves it, which then hold most of the wide groups. The population
    enters a second time moved to the next year, as the value to compare with; it makes no key of
    its own. Repeated values keep the highest.
    """
    # There are seven of them, which share the tasks.
    parts = shuffle_partitions(populations.sparkSession) // 4 + 1

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "id", "year", "first", "second", "value")

    is_commune = F.col("GEO_OBJECT") == "COM"
    census = populations.filter(is_commune)
    period, observed = F.col("TIME_PERIOD"), _whole("OBS_VALUE")
    lived = dealt(_part(census, "population", "GEO", period, observed)).unionByName(
        dealt(_part(overseas, "population", "commune_id", F.col("year"), _whole("population")))
    )
    before = lived.withColumns({"part": F.lit("before"), "year": F.col("year") + 1})
    born = births.filter(is_commune & (F.col("EC_MEASURE") == "LVB"))
    died = deaths.filter(is_commune & (F.col("EC_MEASURE") == "DTH") & (F.col("OBS_STATUS") == "A"))
    stacked = union_all(
        [
            lived,
            before,
            dealt(_part(born, "births", "GEO", period, observed)),
            dealt(_part(died, "deaths", "GEO", period, observed)),
            dealt(_part(family.filter(is_commune), "family", "GEO", period, observed, "NCH", "TFN")),
            dealt(
                _part(
                    migration.filter(F.col("NIVGEO") == "COM"), "migration", "CODGEO",
                    F.lit(K.MIGRATION_YEAR), F.col("NB"), "IMMI", "SEXE",
                )
            ),
        ]
    )
    part, value = F.col("part"), F.col("value")

    def highest(condition: Column) -> Column:
        return F.max(F.when(condition, value)).cast("int")

    def cell(name: str, first: str | None, second: str | None) -> Column:
        condition = part == name
        if first:
            condition = condition & (F.col("first") == first)
        if second:
            condition = condition & (F.col("second") == second)
        return condition

    folded = stacked.groupBy("id", "year").agg(
        F.bool_or(part != "before").alias("_own"),
        *[highest(part == name).alias(name) for name in ("population", "before", "births", "deaths")],
        *[highest(cell("family", *codes)).alias(n) for n, codes in K.FAMILY_CELLS.items()],
        *[
            F.sum(F.when(cell("migration", *codes), value)).alias(n)
            for n, codes in K.MIGRATION_CELLS.items()
        ],
    )
    now, prev = F.col("population"), F.col("before")
    return folded.filter("_own").select(
        "id", "year", year_key(F.col("year")).alias("date_id"),
        "population",
        (now - prev).alias("year_evolution"),
        ratio((now - prev).cast("double") * 100, prev).alias("year_evolution_percent"),
        "births", "deaths", (F.col("births") - F.col("deaths")).alias("birth_death_diff"),
        *K.FAMILY_CELLS, *K.MIGRATION_CELLS,
    )


def fact_salaries(salaries: DataFrame) -> DataFrame:
    """Mean salaries by occupation and sex; the overall mean takes both sexes together."""
    value = F.round(F.col("OBS_VALUE").cast("decimal(38,6)"), 0).cast("int")
    cells = {}
    for suffix, sex in K.SEXES.items():
        cells[f"mean_salary{suffix}"] = ((F.col("SEX") == sex) & (F.col("PCS_ESE") == "_T"), value)
        for name, code in K.OCCUPATIONS.items():
            cells[f"mean_salary_{name}{suffix}"] = (
                (F.col("SEX") == sex) & (F.col("PCS_ESE") == code), value,
            )
    rows = salaries.filter(F.col("GEO_OBJECT") == "COM").withColumns(
        {"id": F.col("GEO"), "year": F.col("TIME_PERIOD").cast("int")}
    )
    return pivot_when(rows, ["id", "year"], cells).withColumn("date_id", year_key(F.col("year")))


def stage_unemployment(deliveries: Sequence[tuple[int, DataFrame]]) -> DataFrame:
    """Yearly deliveries (one per scope) to one table: columns of the year, prefix removed."""
    return union_all(
        [prefixed(df, "CODGEO", f"P{year % 100:02d}_", year=year) for year, df in deliveries]
    )


def fact_unemployment(staged: DataFrame) -> DataFrame:
    """Labour force, unemployed and rates by age and sex, with the change to the year before."""
    have = set(staged.columns)

    def read(name: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast("decimal(18,3)")

    labour, unemployed = {}, {}
    for band, ages in K.AGE_BANDS.items():
        for sex, letter in K.LABOUR_SEXES.items():
            labour[f"labor_force_count_{sex}_{band}"] = read(f"{letter}ACT{ages}")
            unemployed[f"unemployed_count_{sex}_{band}"] = read(f"{letter}CHOM{ages}")
        unemployed[f"unemployed_count_total_{band}"] = total_or_parts(
            read(f"CHOM{ages}"), read(f"HCHOM{ages}"), read(f"FCHOM{ages}")
        )
    counts = staged.select(
        F.col("CODGEO").alias("commune_code"),
        F.col("year").cast("int").alias("year"),
        *[c.alias(n) for n, c in {**labour, **unemployed}.items()],
    )
    rates = {
        f"unemployment_rate_{sex}_{band}": ratio(
            F.col(f"unemployed_count_{sex}_{band}"), F.col(f"labor_force_count_{sex}_{band}"), 100
        )
        for band in K.AGE_BANDS
        for sex in K.LABOUR_SEXES
    }
    reliable = tiers_from(
        F.col("labor_force_count_total_15_64"), [(500, "reliable"), (200, "caution")], "unreliable"
    )
    rated = counts.withColumns({**rates, "reliability_flag": reliable})
    followed = {
        "labor_force_count_total_15_64": "labor_force_evolution_total_15_64",
        "unemployed_count_total_15_64": "unemployed_evolution_total_15_64",
        "unemployment_rate_total_15_64": "unemployment_rate_evolution_total_15_64",
    }
    paired = prior_period(rated, ["commune_code"], "year", list(followed))
    return paired.withColumns(
        {name: F.col(c) - F.col(f"prev_{c}") for c, name in followed.items()}
    )


def income_mapping(year: int) -> dict[str, str]:
    """Common measure -> column name in the wide files of a year."""
    stems = {**K.INCOME_STEMS, **K.INCOME_EXCEPTIONS.get(year, {})}
    if year in K.LIMITED_INCOME_YEARS:
        cut = K.INCOME_MEASURES.index("activity_income_share") + 1
        stems = {m: s for m, s in stems.items() if m in K.INCOME_MEASURES[:cut]}
    return {m: f"{stem}{year % 100:02d}" for m, stem in stems.items() if stem}


def stage_income_year(
    year: int, income: DataFrame, poverty: DataFrame | None = None, poverty_order: str | None = None
) -> DataFrame:
    """One yearly wide file to the common columns. Poverty rates come from a second file in most
    years; of repeated codes there the last one counts."""
    wide = harmonize(
        income, "CODGEO", income_mapping(year), K.INCOME_MEASURES,
        year=year, methodology_version="filosofi_1",
    )
    if poverty is None:
        return wide
    rate = number(F.col(f"{K.POVERTY_STEM}{year % 100:02d}").cast("string"))
    rows = poverty.select(
        F.col("CODGEO").alias("id"), rate.alias("_rate"),
        (F.col(poverty_order) if poverty_order else F.lit(0)).alias("_order"),
    )
    rates = last_wins(rows, "id", "_order").drop("_order")
    joined = wide.drop("poverty_rate").join(rates, "id", "left")
    return joined.withColumnRenamed("_rate", "poverty_rate").select(*wide.columns)


def stage_income_long(year: int, rows: DataFrame, order: str) -> DataFrame:
    """The long format (one row per measure) to the common columns."""
    trimmed = lambda c: F.btrim(F.col(c), F.lit(' "'))
    communes = rows.filter(trimmed("GEO_OBJECT") == "COM").select(
        trimmed("GEO").alias("id"), trimmed("FILOSOFI_MEASURE").alias("measure"),
        number(F.col("OBS_VALUE")).alias("value"), F.col(order).alias("_order"),
    )
    wide = long_to_wide(communes, ["id"], "measure", "value", "_order", K.LONG_INCOME)
    missing = [m for m in K.INCOME_MEASURES if m not in wide.columns]
    return wide.withColumns(
        {"year": F.lit(year), "methodology_version": F.lit("filosofi_2"),
         **{m: F.lit(None).cast("double") for m in missing}}
    ).select("id", "year", "methodology_version", *K.INCOME_MEASURES)


def stage_income(years: Sequence[DataFrame]) -> DataFrame:
    """All years stacked; of a repeated commune and year the earlier delivery stays."""
    stacked = union_all([df.withColumn("_delivery", F.lit(i)) for i, df in enumerate(years)])
    order = [F.col("_delivery"), F.xxhash64(*K.INCOME_MEASURES)]
    return dedupe_first(stacked, ["id", "year"], order).drop("_delivery")


def fact_income(income: DataFrame) -> DataFrame:
    """Typed income rows. Districts of the three cities are left out, the city row stays."""
    spec = [("id", "id", "string"), ("year", "year", "int"), ("methodology_version", "methodology_version", "string")]
    spec += [(m, m, "int" if m.startswith("nb_") else "float") for m in K.INCOME_MEASURES]
    if dict(income.dtypes)["nb_persons"] == "double":
        income = income.withColumns({m: F.bround(m, 0) for m in ("nb_tax_households", "nb_persons")})
    return enforce(income, spec).filter(
        F.col("id") == crosswalk(F.col("id"), K.CITY_CODES)
    ).withColumn("date_id", year_key(F.col("year")))
