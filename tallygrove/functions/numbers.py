"""Ratios, rounding and exact sums.

Money is summed in hundredths and percentages in tenths, both as ``bigint``:
such sums do not depend on the order in which tasks deliver their parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Optional sign, digits with an optional point, optional exponent.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Those that cannot be too large for a double.
_FINITE_TEXT = r"^\s*[+-]?\d{1,300}(?:\.\d*)?\s*$"


def to_number(value: Column) -> Column:
    """Text to double; anything that is not a plain, finite decimal number is NULL.

    The pattern keeps out texts such as ``5d`` or ``NaN`` that the JVM parser
    would accept.  Plain digits, as most texts are, are matched and read once.
    """
    number = value.try_cast("double")
    return F.when(value.rlike(_FINITE_TEXT), number).when(value.rlike(NUMERIC_TEXT), finite(number))


def finite(number: Column) -> Column:
    """The number, or NULL where it is infinite or not a number."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def round_half_away(value: Column, digits: int) -> Column:
    """Round halves away from zero, on the binary value times ``10**digits``."""
    scale = 10.0**digits
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale + 0.0


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in double; NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_of(part: Column, whole: Column) -> Column:
    """Unrounded percentage, NULL on a zero whole."""
    return safe_ratio(part.cast("double") * 100.0, whole)


def rounded_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_half_away(percent_of(part, whole), digits)


def hundredths(amount: Column) -> Column:
    """Money as a whole number of hundredths.

    ``floor`` stays on primitive doubles, where ``round`` would build a
    BigDecimal per row.
    """
    return F.floor(amount.cast("double") * 100.0 + 0.5)


def sum_money(amount: Column) -> Column:
    """Exact sum of a money column, as double."""
    return F.sum(hundredths(amount)) / 100.0


def sum_money_when(condition: Column, amount: Column) -> Column:
    """Exact ``SUM(CASE WHEN condition THEN amount ELSE 0 END)``."""
    return F.sum(F.when(condition, hundredths(amount)).otherwise(0)) / 100.0


def exact_sum(value: Column) -> Column:
    """Sum of a measure to six decimals, as double; does not depend on task order."""
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def tenths(value: Column) -> Column:
    """A value rounded to one decimal, as a whole number of tenths."""
    return (F.signum(value) * F.floor(F.abs(value) * 10.0 + 0.5)).cast("bigint")


def mean_of_tenths(tenth_count: Column) -> Column:
    """Mean of values held as tenths, rounded to one decimal; NULLs are left out."""
    return round_half_away(
        safe_ratio(F.sum(tenth_count), F.count(tenth_count).cast("double") * 10.0), 1
    )


def count_where(condition: Column) -> Column:
    """Number of rows on which the condition is true, 0 on an empty input."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
