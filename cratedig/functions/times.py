"""Time, ratio and formatting expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

ENV_TTL_SECONDS = {"development": 600, "staging": 3600, "production": 86400}
DEFAULT_TTL_SECONDS = 3600


def at(as_of: str | datetime | Column) -> Column:
    """The explicit "now" of a report as a zone-less timestamp column."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def ago(as_of, *, days=0, hours=0, minutes=0, seconds=0) -> Column:
    """``as_of`` minus a constant span; folds to a literal, so it is pushed to the scan."""
    span = F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds).cast("decimal(18,6)"))
    return at(as_of) - span


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def seconds_since(c: Column, as_of) -> Column:
    return (micros(at(as_of)) - micros(c)) / F.lit(1_000_000.0)


def minutes_since(c: Column, as_of) -> Column:
    return (micros(at(as_of)) - micros(c)) / F.lit(60_000_000.0)


def hours_since(c: Column, as_of) -> Column:
    return (micros(at(as_of)) - micros(c)) / F.lit(3_600_000_000.0)


def trunc_hour(c: Column) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def trunc_to(unit: str, c: Column) -> Column:
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def day_of(c: Column) -> Column:
    return F.to_date(c)


def slice_of(c: Column, seconds: int) -> Column:
    """Number of the fixed-width time slice a timestamp falls in (order preserving)."""
    return F.floor(micros(c) / F.lit(seconds * 1_000_000))


def safe_ratio(a: Column, b: Column, default: float | None = None) -> Column:
    """a / b, null (or ``default``) when b is zero or null."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def pct_completion(count: Column, expected: Column) -> Column:
    """Whole percent done; ties go to the even number; 100 when nothing is expected."""
    return F.when(
        expected > 0, F.bround(count.cast("double") / expected * 100)
    ).otherwise(F.lit(100.0))


def fixed(c: Column, digits: int) -> Column:
    """Decimal text with a fixed number of digits, halves rounded up."""
    return F.format_string(f"%.{digits}f", F.round(c.cast("double"), digits))


def trimmed_number(c: Column, digits: int) -> Column:
    return F.round(c.cast("double"), digits).cast("string")


def human_eta(hours: Column) -> Column:
    """Remaining time as text: minutes below an hour, hours below a day, else days."""
    return (
        F.when(hours.isNull(), F.lit("Cannot estimate"))
        .when(hours < 1, F.concat(fixed(hours * 60, 0), F.lit(" minutes")))
        .when(hours < 24, F.concat(fixed(hours, 1), F.lit(" hours")))
        .otherwise(F.concat(fixed(hours / 24, 1), F.lit(" days")))
    )


def env_ttl_seconds(environment: str | None) -> int:
    """TTL by environment name; names are matched by their usual fragments."""
    name = (environment or "development").lower()
    if "prod" in name:
        return ENV_TTL_SECONDS["production"]
    if "stag" in name or "test" in name:
        return ENV_TTL_SECONDS["staging"]
    return ENV_TTL_SECONDS["development"]
