"""Small Column builders that pin down null handling and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.schemas import PEAK_WINDOWS

MICROS_PER_MINUTE = 60_000_000


def flag(condition: Column) -> Column:
    """A predicate that is false, not NULL, when an input is missing."""
    return F.coalesce(condition, F.lit(False))


def share(condition: Column) -> Column:
    """Share of the group's rows for which a never-NULL flag holds."""
    return F.avg(condition.cast("double"))


def known(value: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(value), value)


def clip(value: Column, low: float | int, high: float | int) -> Column:
    """Clamp to [low, high]; least/greatest skip NULLs, so a NULL is guarded."""
    return F.when(
        value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high))
    )


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Whole microseconds from start to end.

    Subtracting zone-less timestamps never looks at the session's time zone, unlike
    timestamp_diff, which is off by the clock change when a time falls into one.
    """
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("long")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes with microsecond resolution."""
    return as_minutes(micros_between(start, end))


def as_minutes(micros: Column) -> Column:
    return micros / F.lit(float(MICROS_PER_MINUTE))


def round_even(value: Column, digits: int | None) -> Column:
    """Round the scaled value half to even; ``None`` leaves the value alone."""
    if digits is None:
        return value
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def rounded(df: DataFrame, columns: list[str], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


def is_peak(window: Column) -> Column:
    return flag(window.isin(*PEAK_WINDOWS))


def congestion(speed_ratio: Column) -> Column:
    """0 = free flow, 1 = standstill."""
    return 1 - clip(speed_ratio, 0.0, 1.0)


def congestion_color(score: Column) -> Column:
    """RGBA array of a congestion score: red when slow, green when free."""
    return F.when(
        score.isNotNull(),
        F.array(
            F.floor(255 * score).cast("int"),
            F.floor(200 * (1 - score)).cast("int"),
            F.lit(60),
            F.lit(190),
        ),
    )
