"""Casts, ratios and rounding that agree with dataframe libraries on NaN and ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers as text. Spark alone would also take Java forms such as "1.5d" or
# "0x1Ap0", and "nan".
_DECIMAL = r"^[\t-\r ]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[\t-\r ]*$"
_INFINITE = r"(?i)^[\t-\r ]*[+-]?inf(?:inity)?[\t-\r ]*$"


def strict_long(value: Column) -> Column:
    """Cast that fails the query on malformed text; null stays null."""
    number = value.try_cast("bigint")
    complaint = F.concat(F.lit("not an integer: "), value.cast("string"))
    return F.coalesce(number, F.when(value.isNotNull(), F.raise_error(complaint)).cast("bigint"))


def number_or_null(text: Column) -> Column:
    """Double from text; what is no number, NaN, or too large is null."""
    number = text.try_cast("double")
    finite = text.rlike(_DECIMAL) & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite | text.rlike(_INFINITE), number)


def number_text(number: Column) -> Column:
    """A double as the text that Python and DuckDB give: an exponent only below 1e-4 and from 1e16 on.

    The digits are those of the JVM, which wants an exponent below 1e-3 and from 1e7 on.
    """
    text = number.cast("string")
    # All 17 digits of a double fit behind the point and before it.
    digits = F.regexp_replace(text.try_cast(T.DecimalType(38, 21)).cast("string"), "0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    power = F.regexp_extract(text, "E-?([0-9]+)$", 1)
    padded = F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power)
    sign = F.when(text.contains("E-"), "e-").otherwise("e+")
    scientific = F.concat(F.regexp_replace(text, r"(\.0)?E.*$", ""), sign, padded)
    infinite = F.replace(F.lower(text), F.lit("infinity"), F.lit("inf"))
    size = F.abs(number)
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(text.contains("E"), scientific)
        .otherwise(infinite)
    )


def true_or_false(flag: Column) -> Column:
    """Boolean with null as false."""
    return F.coalesce(flag.cast("boolean"), F.lit(False))


def round_half_even(value: Column, places: int) -> Column:
    """Round the scaled double to the nearest even; ``F.round`` rounds ties up."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double; null when there is nothing to divide."""
    return F.try_divide(part, whole) * F.lit(100.0)


def exact_mean(value: Column, places: int) -> Column:
    """Mean of doubles already rounded to ``places``.

    The sum is decimal, so it does not depend on the order in which tasks
    deliver their parts, and a tie at the next rounding is a real tie.
    """
    total = F.sum(value.cast(T.DecimalType(28, places))).cast("double")
    return F.try_divide(total, F.count(value))


def missing(name: str, data_type: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    column = F.col(name)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
