"""Guarded arithmetic, whole-day differences and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def guarded_ratio(a: Column, b: Column) -> Column:
    """``a / b`` as a double, with a zero denominator read as 1."""
    denominator = F.coalesce(F.nullif(b.cast("double"), F.lit(0.0)), F.lit(1.0))
    return a.cast("double") / denominator


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound ``c`` from below and above; nulls stay null."""
    out = c
    if low is not None:
        out = F.when(c.isNotNull(), F.greatest(out, F.lit(low)))
    if high is not None:
        out = F.when(c.isNotNull(), F.least(out, F.lit(high)))
    return out


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole days, floored, so minus one hour is -1. Not a difference of calendar days."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.round((micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("bigint")


def days_before(ts: Column, days: int) -> Column:
    """The moment ``days`` days before ``ts``."""
    return ts - F.make_dt_interval(F.lit(days))


def units(c: Column, scale: int) -> Column:
    """A finite amount as a whole number of 10**-scale units; one beyond the bigint range raises in any mode.

    Whole numbers add up to the same total in any order, so retried or re-partitioned sums agree to
    the last digit.
    """
    whole = F.round(c.cast("double") * F.lit(float(10**scale)))
    return F.when(F.abs(whole) < F.lit(2.0**63), whole.cast("bigint")).when(whole.isNotNull(), _too_large())


def _too_large() -> Column:
    return F.raise_error(F.lit("an amount or total is beyond the range of whole units")).cast("bigint")


def checked_sum(value: Column) -> Column:
    """The sum of whole numbers, 0 over none. A total beyond the bigint range raises, whether ANSI mode is on or not."""
    total = F.try_sum(F.coalesce(value, F.lit(0).cast("bigint")))
    return F.when(total.isNotNull(), total).when(F.count(F.lit(1)) == 0, F.lit(0).cast("bigint")).otherwise(_too_large())


def from_units(total: Column, scale: int) -> Column:
    """Back from whole units to a double."""
    return total.cast("double") / F.lit(float(10**scale))


def exact_sum(c: Column, where: Column | None = None, scale: int = 4) -> Column:
    """Order-independent sum of a money column, 0 over no rows."""
    value = units(c, scale)
    return from_units(checked_sum(value if where is None else F.when(where, value)), scale)
