"""Visited places and the visit-time model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import multiplier, rebase_path, round_even, round_exact, tiers
from cadastra.operators.aggregates import badges, completeness
from cadastra.operators.history import current
from cadastra.plans import constants as K


def visited_master(
    communes: DataFrame,
    geography: DataFrame,
    population: DataFrame,
    visited: DataFrame,
    year: int,
    thumbnail_base: str,
) -> DataFrame:
    """Every commune in force with its geography, population of one year and visit, if any."""
    here = current(communes) if "is_current" in communes.columns else communes
    shapes = current(geography) if "is_current" in geography.columns else geography
    return (
        here.select(
            "id", "name", "department_code", "department_name", "region_name", "territory_type"
        )
        .join(
            shapes.select(
                F.col("commune_id").alias("id"), "area_km2",
                F.col("centroid.y").alias("latitude"), F.col("centroid.x").alias("longitude"),
                "is_mountain", "is_island_commune",
            ),
            "id",
        )
        .join(population.filter(F.col("year") == year).select("id", "population"), "id", "left")
        .join(
            visited.filter("visited").select("id", "visited", "visit_date", "photo"), "id", "left"
        )
        .withColumn("photo_thumbnail_url", rebase_path(F.col("photo"), "DCIM/", thumbnail_base))
    )


def referenced_photos(master: DataFrame) -> DataFrame:
    return master.filter("photo is not null").select("photo").distinct()


def department_completeness(master: DataFrame) -> DataFrame:
    """Visited share of each department that has a visit."""
    return completeness(
        master, ["department_code", "department_name", "region_name"], F.col("visited")
    ).filter("n_done > 0")


def map_points(master: DataFrame, digits: int = 5) -> DataFrame:
    """Map dots: rounded position, name, population (0 if unknown) and layer."""
    return master.filter("latitude is not null and longitude is not null").select(
        "id", round_exact(F.col("latitude"), digits).alias("latitude"), round_exact(F.col("longitude"), digits).alias("longitude"),
        "name", F.coalesce("population", F.lit(0)).alias("population"),
        F.coalesce("visited", F.lit(False)).alias("visited"),
    )


def visit_kpis(master: DataFrame) -> DataFrame:
    """Key figures of the visits in one row: per-department and per-region counts are folded
    first, so one pass over the master is enough."""
    seen = F.coalesce(F.col("visited"), F.lit(False))
    per_department = master.groupBy("region_name", "department_code").agg(
        F.count("*").alias("n"),
        F.count_if(seen).alias("v"),
        F.sum(F.when(seen, F.col("population"))).alias("population"),
        F.sum(F.when(seen, F.col("area_km2").cast("decimal(28,6)"))).alias("area"),
        F.count_if(seen & F.col("is_mountain")).alias("mountain"),
        F.count_if(seen & F.col("is_island_commune")).alias("island"),
        F.count_if(seen & (F.col("territory_type") == "COM")).alias("overseas"),
        F.count_if(seen & (F.col("id") == "75056")).alias("paris"),
    )
    counts = ["n", "v", "mountain", "island", "overseas", "paris"]
    per_region = per_department.groupBy("region_name").agg(
        *[F.sum(c).alias(c) for c in [*counts, "population", "area"]],
        F.count_if(F.col("v") > 0).alias("departments"),
        F.count_if(F.col("v") == F.col("n")).alias("complete"),
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_region.agg(
        zero("n").alias("n_total"),
        zero("v").alias("n_visited"),
        round_exact(F.sum("v") / F.sum("n") * 100, 2).alias("pct_visited"),
        zero("population").alias("population_visited"),
        round_exact(F.sum("area"), 0).alias("area_visited"),
        zero("departments").alias("n_departments"),
        F.count_if(F.col("v") > 0).alias("n_regions"),
        zero("complete").alias("departments_completed"),
        F.count_if(F.col("v") == F.col("n")).alias("regions_completed"),
        zero("mountain").alias("mountain_visited"),
        zero("island").alias("island_visited"),
        zero("overseas").alias("overseas_visited"),
        zero("paris").alias("paris_visited"),
    )


def visit_badges(master: DataFrame) -> DataFrame:
    return badges(visit_kpis(master), K.BADGES)


# -- visit time ---------------------------------------------------------------------------


def visit_base(
    communes: DataFrame, geography: DataFrame, monument_stats: DataFrame,
    population: DataFrame, year: int,
) -> DataFrame:
    """Inputs of the model: one row per commune in force."""
    here = current(communes) if "is_current" in communes.columns else communes
    shapes = current(geography) if "is_current" in geography.columns else geography
    flags = ["is_mountain", "is_coast", "is_insular", "is_island_commune"]
    return (
        here.select(
            F.col("id").alias("commune_id"), "name", "department_code", "department_name",
            "region_name", "flag_metropole",
        )
        .join(shapes.select("commune_id", *flags), "commune_id", "left")
        .join(monument_stats.select("commune_id", "total_monuments"), "commune_id", "left")
        .join(
            population.filter(F.col("year") == year).select(F.col("id").alias("commune_id"), "population"),
            "commune_id", "left",
        )
        .withColumn("total_monuments", F.coalesce("total_monuments", F.lit(0)))
    )


def visit_minutes(base: DataFrame) -> DataFrame:
    """Minutes per commune: population tier and monuments, times terrain, plus ferries; a day at
    most. Terrain factors are a product of column expressions, no per-row function."""
    monuments = F.col("total_monuments")
    stay = tiers(
        F.col("population"), K.VISIT_MINUTES, K.VISIT_MINUTES_LARGEST, missing=K.VISIT_MINUTES_UNKNOWN
    )
    sights = F.least(
        F.when(monuments > K.MONUMENT_FLOOR, monuments - K.MONUMENT_FLOOR + K.MONUMENT_BONUS).otherwise(0),
        F.lit(K.MONUMENT_CAP),
    )
    terrain = multiplier(
        [
            (F.col("is_mountain"), K.MOUNTAIN_FACTOR),
            (F.col("is_coast"), K.COAST_FACTOR),
            (F.col("is_island_commune"), K.ISLAND_FACTOR),
        ]
    )
    ferry = (
        F.when(F.col("commune_id").isin(K.ISLANDS["Îles du Ponant"]), K.SINGLE_ISLAND_MINUTES)
        .when(F.col("commune_id").isin(K.ISLANDS["Belle-Île"]), K.SHARED_ISLAND_MINUTES)
        .otherwise(0)
    )
    minutes = F.least(((stay + sights) * terrain + ferry).cast("bigint"), F.lit(K.MINUTES_PER_DAY))
    timed = base.withColumn("visit_minutes", minutes)
    return timed.withColumn("visit_hours", round_even(F.col("visit_minutes") / 60, 2))


def with_overseas(df: DataFrame) -> DataFrame:
    """Travel days and shared trip of overseas departments; 0 and blank elsewhere."""
    trips = df.sparkSession.createDataFrame(
        K.OVERSEAS_TRIPS, "department_code string, _days int, _group string"
    )
    # A fixed list of a dozen rows.
    return df.join(F.broadcast(trips), "department_code", "left").select(
        *df.columns,
        F.coalesce("_days", F.lit(0)).alias("overseas_travel_days"),
        F.coalesce("_group", F.lit("")).alias("overseas_group"),
    )


def _hours(column: str = "visit_hours") -> Column:
    """Exact sum of two-decimal hours."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def department_summary(timed: DataFrame) -> DataFrame:
    dense = F.col("department_code").isin(K.DENSE_DEPARTMENTS)
    drive = F.when(dense, K.DENSE_DRIVE_MINUTES).otherwise(K.RURAL_DRIVE_MINUTES)
    travel = round_even((F.col("n_towns") - 1) * drive / 60, 1)
    total = F.col("total_visit_hours") + F.col("intra_travel_hours")
    return (
        timed.groupBy("department_code")
        .agg(
            F.min("department_name").alias("department_name"),
            F.min("region_name").alias("region_name"),
            F.min("flag_metropole").alias("flag_metropole"),
            F.count("*").alias("n_towns"),
            _hours().alias("total_visit_hours"),
            F.max("overseas_travel_days").alias("overseas_travel_days"),
        )
        .withColumn("intra_travel_hours", travel)
        .withColumn("total_hours", round_even(total, 1))
        .withColumn("total_days", round_even(total / K.HOURS_PER_DAY, 1))
    )


def _transfers(groups: Column) -> Column:
    """Hours between the departments of a region."""
    return F.greatest(groups - 1, F.lit(0)) * F.lit(K.DEPARTMENT_DRIVE_HOURS)


def region_summary(departments: DataFrame) -> DataFrame:
    exact = lambda c, s: F.sum(F.col(c).cast(f"decimal(18,{s})")).cast("double")
    rolled = departments.groupBy("region_name").agg(
        F.sum("n_towns").cast("bigint").alias("n_towns"),
        exact("total_visit_hours", 2).alias("_visit"),
        (exact("intra_travel_hours", 1) + _transfers(F.count("*"))).alias("_travel"),
    )
    return rolled.select(
        "region_name", "n_towns",
        round_exact(F.col("_visit"), 0).alias("visit_hours"),
        round_exact(F.col("_travel"), 0).alias("travel_hours"),
        round_exact((F.col("_visit") + F.col("_travel")) / K.HOURS_PER_DAY, 1).alias("total_days"),
    )


def overseas_summary(timed: DataFrame) -> DataFrame:
    return (
        timed.filter((F.col("flag_metropole") == 0) & (F.col("overseas_group") != ""))
        .groupBy("overseas_group")
        .agg(
            F.count("*").alias("n_towns"),
            _hours().alias("total_visit_hours"),
            F.max("overseas_travel_days").alias("travel_days"),
        )
        .withColumn(
            "total_days",
            round_even(F.col("total_visit_hours") / K.HOURS_PER_DAY + F.col("travel_days"), 1),
        )
    )


def trip_days() -> int:
    """Travel days with each shared trip counted once (a fixed list)."""
    return sum(days for _, days in {(group, days) for _, days, group in K.OVERSEAS_TRIPS})


def grand_total(departments: DataFrame) -> DataFrame:
    """Days for the whole tour: mainland with transfers, overseas, and the flights."""
    hours = lambda flag: F.sum(
        F.when(F.col("flag_metropole") == flag, F.col("total_hours").cast("decimal(18,1)"))
    )
    rolled = departments.groupBy("region_name").agg(
        F.count("*").alias("n"), hours(1).alias("main"), hours(0).alias("away")
    )
    total = lambda c: F.coalesce(F.sum(c).cast("double"), F.lit(0.0))
    days = rolled.agg(
        ((total("main") + F.sum(_transfers(F.col("n")))) / K.HOURS_PER_DAY).alias("mainland_days"),
        (total("away") / K.HOURS_PER_DAY).alias("overseas_days"),
    ).withColumn("travel_days", F.lit(trip_days()))
    return days.withColumn(
        "grand_total_days", F.col("mainland_days") + F.col("overseas_days") + F.col("travel_days")
    )


def tour_kpis(timed: DataFrame) -> DataFrame:
    """Head counts of the tour in one row."""
    return timed.agg(
        F.count("*").alias("n_towns"),
        F.sum("total_monuments").cast("bigint").alias("n_monuments"),
        F.count_if("is_mountain").alias("n_mountain"),
        F.count_if("is_coast").alias("n_coast"),
        F.count_if("is_insular").alias("n_insular"),
        F.count_if("is_island_commune").alias("n_island_commune"),
        F.count_distinct("overseas_group").alias("n_overseas_groups"),
        F.count_if(F.col("visit_minutes") >= K.MINUTES_PER_DAY).alias("n_full_day"),
    )
