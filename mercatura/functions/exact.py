"""Column expressions whose result does not depend on row order or partitioning.

Sums run on decimals, so a retried or re-split stage adds up to the same value; the cast to
double comes last. All of it stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000.0

# Holds any 64-bit whole number; sums of it widen to 30 digits.
WHOLE = "decimal(20,0)"

# Seconds to the microsecond, for any two dates of the calendar.
SECONDS = "decimal(18,6)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# What amounts that are no decimals may hold: so many places, and twelve digits before them.
PLACES = 6
AMOUNT = f"decimal(18,{PLACES})"


def exact(df: DataFrame, name: str) -> Column:
    """The column as a decimal: decimals as they are, whole numbers widened.

    A floating-point value must be one that ``AMOUNT`` can hold; any other raises when it is
    read, so no digit is lost unseen. Cast such a column to a decimal of choice instead.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DecimalType):
        return F.col(name)
    if isinstance(dtype, T.IntegralType):
        return F.col(name).cast(WHOLE)
    held = F.col(name).try_cast(AMOUNT)
    lost = F.concat(F.lit(f"{name} does not fit {AMOUNT}: "), F.col(name).cast("string"))
    return F.when(F.col(name).isNull() | (held.cast(dtype) == F.col(name)), held).otherwise(
        F.raise_error(lost).cast(AMOUNT)
    )


def total(column: Column | str) -> Column:
    """Sum of whole numbers that cannot overflow."""
    return F.sum(_column(column).cast(WHOLE))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; a zero denominator gives NULL."""
    bottom = _column(denominator).cast("double")
    return _column(numerator).cast("double") / F.nullif(bottom, F.lit(0.0))


def mean(summed: Column | str, counted: Column | str) -> Column:
    """Average from an exact sum and its count; NULL where nothing was counted."""
    return ratio(summed, counted)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part.cast("double") * F.lit(100.0), whole)


def month_of(column: Column | str) -> Column:
    """First instant of the month. Goes through DATE, so no session zone is involved."""
    return F.trunc(column, "month").cast("timestamp_ntz")


def elapsed(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end`` as decimal, to the microsecond; may be negative.

    Between zoneless timestamps this is a difference of wall clocks in any session zone. The
    type holds the whole calendar.
    """
    return (_column(end) - _column(start)).cast("interval second").cast(SECONDS)


def since_epoch(column: Column | str) -> Column:
    """A zoneless timestamp as seconds since 1970."""
    return elapsed(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)


def micros(seconds: Column | str) -> Column:
    """Decimal seconds as a whole number of microseconds, still decimal."""
    return _column(seconds) * F.lit(1_000_000)


def mean_elapsed(summed: Column | str, counted: Column | str, micros_per_unit: float) -> Column:
    """Average duration in the unit given, from an exact sum of seconds and its count."""
    return mean(micros(summed), counted) / F.lit(micros_per_unit)
