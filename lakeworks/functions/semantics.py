"""Column helpers that pin down rounding, time and money semantics.

All of them are plain Catalyst expressions, so they stay in generated code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "as_of_date", "round_to", "round2", "cents", "millionths", "money_sum", "money_avg", "ratio",
    "day_of", "week_of", "month_of", "month_range", "date_range", "trailing_days", "trailing_months",
    "seconds_of_day", "seconds_between", "elapsed_seconds", "minute_boundaries", "weekday_name",
    "weekday_number", "strip_all", "null_outside", "nested_total", "trip_efficiency",
]


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: str | dt.date | Column | None) -> Column:
    """The reference date of a report: today, unless the caller fixes it."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


# --- numbers ---------------------------------------------------------------

def round_to(x: str | Column, digits: int) -> Column:
    """Round half away from zero in binary arithmetic (0.285 -> 0.28, as stored).

    ``F.round`` goes through the decimal text of the double and gives 0.29.
    """
    x, scale = as_col(x), float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5).cast("double") / scale


def round2(x: str | Column) -> Column:
    return round_to(x, 2)


def cents(x: str | Column) -> Column:
    """An amount as whole cents, to compare amounts by."""
    return F.rint(as_col(x) * 100).cast("bigint")


def millionths(x: str | Column) -> Column:
    """An amount in whole millionths, exact for up to six decimals: a bigint that adds up the same in any order."""
    return F.rint(as_col(x) * 1_000_000).cast("bigint")


def money_sum(x: str | Column) -> Column:
    """Sum of a money column to six decimals; independent of the order of the rows.

    Whole units and millionths are added as two bigints, which keeps partial aggregation
    in generated code and cannot overflow before nine trillion rows (ANSI mode reports it).
    """
    x = as_col(x)
    whole = F.floor(x)
    units, parts = F.sum(whole), F.sum(millionths(x - whole))
    rest = F.pmod(parts, F.lit(1_000_000).cast("bigint"))
    carried = ((parts - rest) / 1_000_000).cast("bigint")
    return (units + carried).cast("double") + rest.cast("double") / 1_000_000.0


def money_avg(x: str | Column) -> Column:
    return F.try_divide(money_sum(x), F.count(as_col(x)).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# --- time ------------------------------------------------------------------

def day_of(ts: str | Column) -> Column:
    return as_col(ts).cast("date").cast("timestamp_ntz")


def week_of(ts: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(as_col(ts).cast("date"), "week").cast("timestamp_ntz")


def month_of(ts: str | Column) -> Column:
    return F.trunc(as_col(ts).cast("date"), "month").cast("timestamp_ntz")


def month_range(ts: str | Column, month: str) -> Column:
    """Rows of one month ('2024-01') as a half-open range, which Parquet can skip on."""
    start = dt.date.fromisoformat(f"{month}-01")
    end = (start + dt.timedelta(days=32)).replace(day=1)
    return date_range(ts, start, end)


def date_range(ts: str | Column, start, end) -> Column:
    """``start <= ts < end`` with literals typed as the column, so the filter is pushed."""
    ts = as_col(ts)
    low, high = (F.lit(str(v)).cast("timestamp_ntz") for v in (start, end))
    return (ts >= low) & (ts < high)


def trailing_days(ts: str | Column, days: int, as_of=None) -> Column:
    return as_col(ts) >= F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")


def trailing_months(ts: str | Column, months: int, as_of=None) -> Column:
    return as_col(ts) >= F.add_months(as_of_date(as_of), -months).cast("timestamp_ntz")


def seconds_of_day(ts: str | Column) -> Column:
    ts = as_col(ts)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Fractional seconds between two zone-less timestamps, to the millisecond."""
    micros = F.timestamp_diff("MICROSECOND", as_col(earlier), as_col(later))
    return round_to(micros.cast("double") / 1_000_000.0, 3)


def elapsed_seconds(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds between two timestamps, truncated toward zero."""
    return F.timestamp_diff("SECOND", as_col(earlier), as_col(later))


def minute_boundaries(start: str | Column, end: str | Column) -> Column:
    """Minute marks crossed from start to end (00:00:59 to 00:01:01 is 1)."""
    at = [F.date_trunc("minute", as_col(c)).cast("timestamp_ntz") for c in (start, end)]
    return F.timestamp_diff("MINUTE", at[0], at[1])


def weekday_name(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), "EEEE")


def weekday_number(ts: str | Column) -> Column:
    """Monday is 1."""
    return F.weekday(as_col(ts)) + 1


# --- text, outliers, nested ------------------------------------------------

def strip_all(text: str | Column) -> Column:
    """Trim every kind of white space at both ends, not only blanks."""
    return F.regexp_replace(as_col(text), r"^\s+|\s+$", "")


def null_outside(x: str | Column, low=None, high=None, low_inclusive: bool = True) -> Column:
    """The value, or NULL where it lies outside the range."""
    x = as_col(x)
    keep = F.lit(True)
    if low is not None:
        keep = keep & (x >= low if low_inclusive else x > low)
    if high is not None:
        keep = keep & (x <= high)
    return F.when(keep, x)


def nested_total(items: str | Column, price: str = "price", quantity: str = "quantity") -> Column:
    """Sum of price x quantity over an array of structs, without exploding it.

    An item without a price or a quantity adds nothing; without an array the total is NULL.
    """
    return F.aggregate(
        F.transform(as_col(items), lambda i: F.coalesce(i[price] * i[quantity], F.lit(0.0))), F.lit(0.0), lambda a, x: a + x
    )


def trip_efficiency(distance: str | Column, minutes: str | Column) -> Column:
    """Distance per hour; NULL for a duration of 0 minutes."""
    distance, minutes = as_col(distance), as_col(minutes)
    return F.try_divide(distance, minutes.cast("double")) * 60
