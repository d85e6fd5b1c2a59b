"""Column expressions on numbers: exact money sums, rounding, display text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Amounts are added up as whole numbers of this many units per currency unit.
MONEY_UNITS = 10_000
LOW_BITS = 28  # of these units, which are summed apart from the higher ones


def money(column: Column | str) -> Column:
    """An amount as a whole number of units, so that sums of it are exact, do
    not depend on the row order and cannot overflow."""
    value = F.col(column) if isinstance(column, str) else column
    return F.rint(value * MONEY_UNITS).cast("bigint").cast("decimal(18,0)")


def money_sum(column: Column | str) -> Column:
    """Exact sum of amounts, given back as a double.

    The low and the high bits of the units are summed apart, as plain whole numbers:
    decimals wider than these are objects, which cost most of such an aggregate.
    """
    units = money(column).cast("bigint")
    high = F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    return (high * F.lit(1 << LOW_BITS) + low.cast("decimal(20,0)")).cast("double") / MONEY_UNITS


def money_avg(column: Column | str) -> Column:
    """Average of the non-NULL amounts, from the exact sum."""
    return F.try_divide(money_sum(column), F.count(column).cast("double"))


def round_to(column: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, not on the binary one."""
    return F.round(column.cast("decimal(38,10)"), digits).cast("double")


def flag_rate(column: Column | str) -> Column:
    """Share of true among the non-NULL flags."""
    flag = F.col(column) if isinstance(column, str) else column
    return F.avg(flag.cast("int"))


def format_value(column: Column | str, style: str) -> Column:
    """Display text: ``billions`` gives $1.23T / $1.23B / $1,234, else 1.23%."""
    value = F.col(column) if isinstance(column, str) else column

    def two_places(number: Column) -> Column:
        return F.replace(F.format_number(number, 2), F.lit(","), F.lit(""))

    if style == "billions":
        return (F.when(value >= 1e12, F.concat(F.lit("$"), two_places(value / 1e12), F.lit("T")))
                 .when(value >= 1e9, F.concat(F.lit("$"), two_places(value / 1e9), F.lit("B")))
                 .otherwise(F.concat(F.lit("$"), F.format_number(value, 0))))
    return F.concat(two_places(value), F.lit("%"))
