"""Scalar helpers: sample coercion, clipping, calendar, steps and minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_value(text: Column, nan_as_null: bool = False) -> Column:
    """A sample's text as a number; NaN, null and what is no number give 0 (or null)."""
    value = F.nanvl(F.try_cast(text, "double") if hasattr(F, "try_cast") else text.try_cast("double"), F.lit(None).cast("double"))
    return value if nan_as_null else F.coalesce(value, F.lit(0.0))


def epoch_timestamp(seconds: Column) -> Column:
    """Seconds since 1970, perhaps with a fraction, as a UTC timestamp without zone."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def no_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def clip(value: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Keep a value between the bounds; null values and null bounds change nothing."""
    out = value
    if low is not None:
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        out = F.when(out > high, high).otherwise(out)
    return out


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday 0), minute and the cyclic forms of the first two."""
    hour, day = F.hour(ts), F.weekday(ts)
    turn = 2 * F.pi()
    return {
        "hour": hour,
        "day_of_week": day,
        "minute": F.minute(ts),
        "hour_sin": F.sin(turn * hour / 24),
        "hour_cos": F.cos(turn * hour / 24),
        "dow_sin": F.sin(turn * day / 7),
        "dow_cos": F.cos(turn * day / 7),
    }


def steps_to_minutes(steps: Column, per_minute: int = 4) -> Column:
    return F.floor(steps / per_minute).cast("int")


def minutes_to_steps(minutes: Column, per_minute: int = 4) -> Column:
    return (minutes * per_minute).cast("int")


def settled(v: Column, digits: int) -> Column:
    """Rounded, halves up also where the order of a mean's sum left it a little below; means of 32 values have ties at 6 digits."""
    return F.round(v + 10.0 ** (-digits - 3), digits)
