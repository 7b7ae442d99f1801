"""Calendar expressions: date parts, names, Easter and the moon."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions.columns import round_exact, tiers

# Day and month names.
DAYS_FR = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
DAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS_FR = [
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
]
MONTHS_EN = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Days from Easter Sunday of the movable Christian feasts.
EASTER_OFFSETS = [-46, -7, -3, -2, 0, 1, 7, 39, 49, 50, 56, 60, 68]

# Fixed values: (month, day) of the fixed Christian feasts.
FIXED_FEASTS = [
    (1, 1), (1, 6), (2, 2), (3, 19), (3, 25), (6, 24), (6, 29), (8, 6), (8, 15),
    (9, 8), (9, 14), (11, 1), (11, 2), (12, 8), (12, 25), (12, 26), (12, 28),
]

# Upper bound of each moon phase on the 0-28 scale.
MOON_PHASES = [
    (1.0, "New Moon"),
    (6.0, "Waxing Crescent"),
    (8.0, "First Quarter"),
    (13.0, "Waxing Gibbous"),
    (15.0, "Full Moon"),
    (20.0, "Waning Gibbous"),
    (22.0, "Last Quarter"),
    (27.0, "Waning Crescent"),
]
SYNODIC_MONTH = 29.53059
LUNATION_EPOCH = "1923-01-17"


def iso_weekday(date: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(date) + 1


def is_weekend(date: Column) -> Column:
    return iso_weekday(date) >= 6


def _name(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def day_name(date: Column, language: str = "fr") -> Column:
    return _name(DAYS_FR if language == "fr" else DAYS_EN, iso_weekday(date))


def month_name(date: Column, language: str = "fr") -> Column:
    return _name(MONTHS_FR if language == "fr" else MONTHS_EN, F.month(date))


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def slashed_date(text: Column) -> Column:
    """``YYYY/M/D`` text to a date; anything else is NULL."""
    return F.try_to_date(text, "yyyy/M/d")


def stamp_of(path: Column) -> Column:
    """The sortable ``YYYYMMDDTHHMMSS`` stamp in a file name, as a timestamp."""
    text = F.regexp_extract(path, r"_(\d{8}T\d{6})(?=\.[^./]+$)", 1)
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd'T'HHmmss"))


def stamped_name(base: str, moment: Column, extension: str) -> Column:
    return F.concat(
        F.lit(base + "_"), F.date_format(moment, "yyyyMMdd'T'HHmmss"), F.lit(extension)
    )


def easter(year: Column) -> Column:
    """Easter Sunday in the Gregorian calendar, by Gauss's rule with the lunar
    correction of the reform (integer arithmetic only)."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    century = div(year, 100)
    golden = F.pmod(year, F.lit(19))
    # M and N shift the Julian moon and weekday to the Gregorian calendar.
    m = F.pmod(15 - div(13 + 8 * century, 25) + century - div(century, 4), F.lit(30))
    n = F.pmod(4 + century - div(century, 4), F.lit(7))
    moon = F.pmod(19 * golden + m, F.lit(30))
    sunday = F.pmod(
        2 * F.pmod(year, F.lit(4)) + 4 * F.pmod(year, F.lit(7)) + 6 * moon + n, F.lit(7)
    )
    after = moon + sunday
    # Gauss's two exceptions move a too late Easter one week earlier.
    late = ((moon == 29) & (sunday == 6)) | ((moon == 28) & (sunday == 6) & (golden > 10))
    days = F.when(late, after - 7).otherwise(after)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), days.cast("int"))


def christian_feasts(year: Column) -> Column:
    """All movable and fixed feasts of a year, as an array of dates."""
    sunday = easter(year)
    movable = [F.date_add(sunday, F.lit(days)) for days in EASTER_OFFSETS]
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_FEASTS]
    return F.array_distinct(F.array(*movable, *fixed))


def moon_phase_name(phase: Column) -> Column:
    return tiers(phase, MOON_PHASES, "New Moon")


def moon_illumination(phase: Column) -> Column:
    """Linear approximation: 1 at full moon (14), 0 at new moon, two decimals."""
    distance = F.abs(phase - F.lit(14.0)) / F.lit(14.0)
    return round_exact(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - distance)), 2)


def lunation(date: Column) -> Column:
    """Brown lunation number (days since the epoch, truncated toward zero, plus one)."""
    days = F.datediff(date, F.to_date(F.lit(LUNATION_EPOCH)))
    return (days / F.lit(SYNODIC_MONTH)).cast("int") + 1


def market_closed(date: Column, is_session: Column, is_public_holiday: Column) -> Column:
    """A weekday on which the exchange does not trade. ``is_session`` is NULL outside the
    published trading calendar; there only public holidays close it."""
    open_ = F.coalesce(is_session, ~F.coalesce(is_public_holiday, F.lit(False)))
    return ~is_weekend(date) & ~open_
