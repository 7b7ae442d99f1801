"""Department reports, panels, example questions and point layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import ratio, ratio_text, trend_text, thousands_text
from cadastra.operators.aggregates import exact_median, group_benchmark, members_of_top_groups, top
from cadastra.operators.history import current
from cadastra.operators.skew import skew_join
from cadastra.operators.windows import latest_per_key
from cadastra.session import pin
from cadastra.sources.writers import collection_columns


def department_report(communes: DataFrame, population: DataFrame, salaries: DataFrame) -> DataFrame:
    """Every commune with its latest population and salary against its department, for all
    departments in one job."""
    newest = [F.col("year").desc()]
    pop = latest_per_key(population, ["id"], newest, F.col("population").isNotNull()).select(
        "id", "population", F.col("year").alias("latest_population_year"),
        F.col("year_evolution_percent").alias("population_growth_pct"),
    )
    pay = latest_per_key(salaries, ["id"], newest, F.col("mean_salary").isNotNull()).select(
        "id", "mean_salary", F.col("year").alias("latest_salary_year")
    )
    cities = communes.select("id", "name", "department_code", "department_name")
    # One narrow row per commune, read for the averages and once more for the rows themselves.
    rows = pin(cities.join(pop, "id", "left").join(pay, "id", "left"))
    compared = group_benchmark(
        rows, ["department_code"],
        {"dept_avg_population": "population", "dept_avg_salary": "mean_salary"},
    )
    return compared.withColumns(
        {
            "population_ratio": ratio(F.col("population"), F.col("dept_avg_population")),
            "salary_ratio": ratio(F.col("mean_salary"), F.col("dept_avg_salary")),
        }
    )


def departments(communes: DataFrame) -> DataFrame:
    return communes.select("department_code", "department_name").distinct()


def city_series(facts: DataFrame, code: str, columns: list[str], newest_first: bool = False) -> DataFrame:
    """The yearly rows of one commune."""
    year = F.col("year")
    return facts.filter(F.col("id") == code).select("year", *columns).orderBy(
        year.desc() if newest_first else year.asc()
    )


def report_text(report: DataFrame) -> DataFrame:
    """The report as formatted text columns."""
    return report.select(
        "id", "name", "department_code",
        thousands_text(F.col("population")).alias("population"),
        trend_text(F.col("population_growth_pct"), 1, "%").alias("population_growth"),
        ratio_text(F.col("population_ratio")).alias("population_ratio"),
        thousands_text(F.col("mean_salary")).alias("mean_salary"),
        ratio_text(F.col("salary_ratio")).alias("salary_ratio"),
    )


def comparison(report: DataFrame) -> DataFrame:
    """City and department value of each metric, scaled to the larger of the two (the department
    to the left of zero). Metrics with an unknown side are left out."""

    def metric(label: str, city: str, dept: str, known: str) -> Column:
        own, mean = F.col(city).cast("double"), F.col(dept).cast("double")
        largest = F.greatest(own, mean)
        return F.struct(
            F.lit(label).alias("metric"),
            own.alias("city_value"),
            mean.alias("dept_value"),
            F.coalesce(F.col(known), ratio(own, mean)).alias("ratio"),
            ratio(-mean, largest, 100).alias("dept_pct"),
            ratio(own, largest, 100).alias("city_pct"),
        )

    metrics = F.array(
        metric("Population", "population", "dept_avg_population", "population_ratio"),
        metric("Mean Salary (€)", "mean_salary", "dept_avg_salary", "salary_ratio"),
    )
    return report.select("id", "department_code", F.inline(metrics)).filter(
        "city_value is not null and dept_value is not null"
    )


def department_panel(communes: DataFrame, population: DataFrame) -> DataFrame:
    """Population per department and year, over the communes in force."""
    here = current(communes) if "is_current" in communes.columns else communes
    rows = here.select("id", "department_code", "department_name").join(
        population.select("id", "year", "population"), "id"
    )
    return rows.groupBy("department_code", "department_name", "year").agg(
        F.sum("population").cast("bigint").alias("total_population")
    )


def latest_slice(panel: DataFrame) -> DataFrame:
    """Rows of the newest year that has a population. Pass a stored panel: it is read twice."""
    return panel.filter(F.col("year") == newest_year(panel))


def newest_year(panel: DataFrame) -> Column:
    return panel.filter("total_population is not null").agg(F.max("year")).scalar()


def panel_kpis(panel: DataFrame) -> DataFrame:
    """Total, mean, median and extremes of the newest year in one row."""
    newest = pin(latest_slice(pin(panel)))
    people = F.col("total_population")
    median = exact_median(newest, [], "total_population", "m").scalar()
    order = F.struct(people, F.col("department_code"))
    return newest.agg(
        F.sum(people).alias("total"),
        F.floor(F.sum(people).cast("double") / F.count(people)).cast("bigint").alias("average"),
        F.max_by("department_name", order).alias("most_populous"),
        F.max(people).alias("most_population"),
        F.min_by("department_name", order).alias("least_populous"),
        F.min(people).alias("least_population"),
    ).withColumn("median", F.floor(median).cast("bigint"))


def panel_extremes(panel: DataFrame, k: int = 10, largest: bool = True) -> DataFrame:
    people = F.col("total_population")
    first = people.desc() if largest else people.asc()
    return top(latest_slice(pin(panel)), k, first, F.col("department_code").asc())


def panel_of_largest(panel: DataFrame, k: int = 5) -> DataFrame:
    """The full series of the departments largest in the newest year."""
    panel = pin(panel)
    newest = newest_year(panel)
    size = F.max(F.when(F.col("year") == newest, F.col("total_population")))
    return members_of_top_groups(panel, "department_code", size, k)


def most_populous(communes: DataFrame, population: DataFrame, year: int, k: int = 10) -> DataFrame:
    rows = communes.select("id", "name", "department_name").join(
        population.filter(F.col("year") == year).select("id", "population"), "id"
    )
    return top(rows, k, F.col("population").desc_nulls_last(), F.col("id").asc())


def pay_gap_by_region(communes: DataFrame, salaries: DataFrame) -> DataFrame:
    """Mean pay of men and women per region and year, and the gap in percent of men's pay."""
    men, women = F.col("mean_salary_men"), F.col("mean_salary_women")
    rows = communes.select("id", "region_name").join(
        salaries.select("id", "year", "mean_salary_men", "mean_salary_women"), "id"
    )
    mean = lambda c: F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))
    return (
        rows.groupBy("region_name", "year")
        .agg(mean(men).alias("avg_men"), mean(women).alias("avg_women"))
        .withColumn("gap_pct", ratio(F.col("avg_men") - F.col("avg_women"), F.col("avg_men"), 100))
    )


def commune_points(communes: DataFrame, geography: DataFrame) -> DataFrame:
    """One point per commune for field collection."""
    rows = communes.select("id", "name", "department_code", "department_name").join(
        geography.select(
            F.col("commune_id").alias("id"),
            F.col("centroid.x").alias("longitude"), F.col("centroid.y").alias("latitude"),
        ),
        "id",
    )
    return collection_columns(rows)


def monument_points(monuments: DataFrame, bridge: DataFrame, communes: DataFrame) -> DataFrame:
    """One point per monument with its primary commune (else the smallest code) that exists."""
    towns = communes.select(
        F.col("id").alias("commune_code"), F.col("name").alias("commune_name"),
        "department_code", "department_name",
    )
    placed = skew_join(bridge, towns, ["commune_code"], "inner", spread=["monument_reference"])
    first = latest_per_key(
        placed, ["monument_reference"], [F.col("is_primary").desc(), F.col("commune_code").asc()]
    ).select(
        F.col("monument_reference").alias("reference"),
        "commune_name", "department_code", "department_name",
    )
    rows = monuments.select(
        "reference", "name", "domain", "denomination", "protection_level", "nature", "century",
        "longitude", "latitude",
    ).join(first, "reference")
    return collection_columns(rows)
