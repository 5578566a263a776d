"""Holidays of any year: days that stay, and days that move with Easter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# National holidays as month * 100 + day, with the first year they are kept.
FIXED_FEASTS = (
    (101, 1), (421, 1), (501, 1), (907, 1), (1012, 1980), (1102, 1), (1115, 1), (1120, 2024), (1225, 1),
)
# Days after Easter of Carnival Monday and Tuesday, Good Friday and Corpus Christi.
MOVABLE_FEASTS = (-48, -47, -2, 60)


def _div(value: Column, by: int) -> Column:
    return F.floor(value / by).cast("int")


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, as a date: the full moon of the church's tables, then the next Sunday."""
    year = year.cast("int")
    century, golden = _div(year, 100), year % 19
    leap_shift = century - _div(century, 4)
    moon_shift = _div(8 * century + 13, 25)
    # Days from 21 March to the full moon; the two latest places of the cycle are moved up by a day.
    age = (19 * golden + leap_shift - moon_shift + 15) % 30
    moon = age - F.when((age == 29) | ((age == 28) & (golden > 10)), 1).otherwise(0)
    full = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), moon)
    return F.next_day(full, "SUN")


def feast_days(years: DataFrame, year: str) -> DataFrame:
    """(year, day, movable) for each distinct year of a column; rows without a year make none."""
    number = F.col("year")
    fixed = [F.when(number >= since, F.struct(F.make_date(number, F.lit(day // 100), F.lit(day % 100)).alias("day"),
                                              F.lit(False).alias("movable"))) for day, since in FIXED_FEASTS]
    movable = [F.struct(F.date_add(easter(number), after).alias("day"), F.lit(True).alias("movable")) for after in MOVABLE_FEASTS]
    return (years.select(F.col(year).cast("int").alias("year")).where("year IS NOT NULL").distinct()
            .select("year", F.inline(F.array_compact(F.array(*fixed, *movable)))))
