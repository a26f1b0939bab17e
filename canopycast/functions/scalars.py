"""Scalar column functions for keys, seasons, dates, ages and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import Settings

DEFAULTS = Settings()


def canonical_key(key: Column) -> Column:
    """``A-007`` and ``A-7-b`` become ``A-7``; NULL unless the second dash part is all digits."""
    text = F.trim(key.cast("string"))
    number = F.split_part(text, F.lit("-"), F.lit(2))
    # \z rather than $: Java lets $ match before a final line break.
    spelled = F.concat_ws("-", F.split_part(text, F.lit("-"), F.lit(1)), number.try_cast("bigint").cast("string"))
    return F.when(number.rlike(r"^[0-9]+\z") & number.try_cast("bigint").isNotNull(), spelled)


def season_label(label: Column) -> Column:
    """``Zafra 2023-2024`` becomes ``2023_2024``."""
    return F.translate(F.regexp_replace(label, r"(?i)^zafra\s+", ""), "-", "_")


def parse_date_multi(text: Column) -> Column:
    """Dates written ``YYYY-MM-DD`` or ``DD/MM/YYYY``; anything else is NULL."""
    text = text.cast("string")
    return (
        F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.try_to_date(text, "yyyy-MM-dd"))
        .when(text.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"), F.try_to_date(text, "dd/MM/yyyy"))
    )


def season_of_date(day: Column, start_month: int = DEFAULTS.season_start_month) -> Column:
    """Season ``y_(y+1)`` holding the day, seasons starting on the first of ``start_month``."""
    first = F.year(day) - F.when(F.month(day) < start_month, 1).otherwise(0)
    return F.concat(first.cast("string"), F.lit("_"), (first + 1).cast("string"))


def cycle_id(lot: Column, season: Column, suffix: str = "") -> Column:
    """Public id of a cycle: lot and season, with ``_open`` for open cycles."""
    return F.concat(lot, F.lit("_"), F.translate(season, "_", "-"), F.lit(suffix))


def nan_to_null(value: Column) -> Column:
    """NaN, as a number or as text, becomes NULL."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def to_numeric(value: Column) -> Column:
    """Number, or NULL where the text is not one."""
    return nan_to_null(value)


def scrub_inf(value: Column) -> Column:
    """Infinite and NaN values become NULL."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def baseline_start(closing: Column, months: Column, days_per_month: float = DEFAULTS.days_per_month) -> Column:
    """Closing date minus the age in months; half days go to the even day."""
    days = F.rint(months * days_per_month).cast("int")
    return F.date_sub(closing, F.greatest(F.lit(0), days))


def corrected_start(baseline: Column, previous: Column, gap: int = DEFAULTS.restart_gap_days) -> Column:
    """Baseline start, but not before ``gap`` days after the previous closing."""
    return F.greatest(baseline, F.date_add(previous, gap))


def age_window(age: Column, as_of_age: Column, s: Settings = DEFAULTS) -> Column:
    """Name of the age window of an observation."""
    return (
        F.when(age.between(0, s.early_end), "age_000_090")
        .when(age.between(s.early_end + 1, s.mid_end), "age_091_180")
        .when(age.between(F.lit(s.mid_end + 1), as_of_age), "age_181_asof")
        .otherwise("outside")
    )


def in_last_days(age: Column, as_of_age: Column, days: int) -> Column:
    """True in the last ``days`` before the as-of age; false for a missing age."""
    return F.coalesce(age >= F.greatest(F.lit(0.0), as_of_age - days), F.lit(False))


def water_balance(rain: Column, evaporation: Column) -> Column:
    return rain - evaporation


def degree_days(mean_temperature: Column, s: Settings = DEFAULTS) -> Column:
    """Growing degree days of a pentad. A missing temperature counts 0: ``greatest`` skips NULL."""
    return F.greatest(mean_temperature - s.base_temperature, F.lit(0.0)) * s.pentad_days


def per_day(total: Column, age: Column) -> Column:
    """Accumulated value per day of age; NULL at age 0."""
    return F.when(age > 0, total / age)


def pct(part: Column, whole: Column) -> Column:
    """Share of rows in percent."""
    return F.try_divide(part, whole) * 100.0
