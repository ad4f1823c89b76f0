"""Special-day lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import NO_SPECIAL_DAY, SPECIAL_DAY_EFFECTS
from delaykit.functions.scalars import day_of, slash_date
from delaykit.operators.lookup import sized_lookup


def special_day_effect(
    df: DataFrame,
    calendar: DataFrame,
    date: str = "FL_DATE",
    out: str = "AssumedEffect_Text",
) -> DataFrame:
    """Left join of the calendar (SpecialDate as month/day/year text) on the row's date."""
    days = calendar.select(
        slash_date("SpecialDate").alias("__day"), F.col("AssumedEffect_Text").alias("__effect")
    )
    return (
        df.withColumn("__on", day_of(F.col(date).cast("string")))
        .join(sized_lookup(days), F.col("__on") == F.col("__day"), "left")
        .withColumn(out, F.coalesce("__effect", F.lit(NO_SPECIAL_DAY)))
        .drop("__on", "__day", "__effect")
    )


def special_day_calendar(years: DataFrame, year: str = "YEAR") -> DataFrame:
    """Calendar rows for every year of a column, by the rules of the US holidays.

    Yields SpecialDate, SpecialDateType and AssumedEffect_Text like the calendar file does;
    shelter-in-place days have no rule and come from a file only.
    """
    new_year = F.make_date(F.col("y"), F.lit(1), F.lit(1))
    christmas = F.make_date(F.col("y"), F.lit(12), F.lit(25))
    november = F.make_date(F.col("y"), F.lit(11), F.lit(1))
    thanksgiving = F.date_add(F.next_day(F.date_sub(november, 1), "Thu"), 21)
    days = {
        "NewYear": new_year,
        "Thanksgiving_m1": F.date_sub(thanksgiving, 1),
        "Thanksgiving": thanksgiving,
        "SunAfterThanksgiving": F.date_add(thanksgiving, 3),
        "Christmas": christmas,
    }
    for n in (1, 2, 3):
        days[f"Christmas_m{n}"] = F.date_sub(christmas, n)
        days[f"Christmas_p{n}"] = F.date_add(christmas, n)
    rows = F.array(
        *[
            F.struct(
                d.alias("day"),
                F.lit(kind).alias("SpecialDateType"),
                F.lit(SPECIAL_DAY_EFFECTS[kind]).alias("AssumedEffect_Text"),
            )
            for kind, d in days.items()
        ]
    )
    exploded = years.select(F.col(year).cast("int").alias("y")).distinct().select(
        F.explode(rows).alias("r")
    )
    return exploded.select(
        F.date_format("r.day", "M/d/yyyy").alias("SpecialDate"),
        "r.SpecialDateType",
        "r.AssumedEffect_Text",
    )
