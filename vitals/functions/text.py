"""Number formatting for text reports.

Any double has a text: what is too large for whole-number arithmetic is
written in digits from its shortest form, infinities by name, and NaN reads N/A, so that one
odd value never ends a report.
"""

from pyspark.sql import Column, functions as F

#: Up to here whole-number arithmetic is safe; doubles beyond have no fraction.
_LARGE = 1e17
_LARGEST_DECIMAL = 1e38


def _unusual(x: Column, digits: Column) -> Column:
    """Text of NaN, infinities and sizes beyond whole-number arithmetic; ``digits`` writes the last."""
    return (
        F.when(F.isnan(x), F.lit("N/A"))
        .when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
        .when(F.abs(x) >= _LARGEST_DECIMAL, x.cast("string"))
        .when(F.abs(x) >= _LARGE, digits)
    )


def fixed1(column: str) -> Column:
    """A column with one decimal, rounded on its exact binary value, ties to even.

    Java's formatter rounds the shortest decimal text instead (0.15 -> 0.2),
    so the comparison with the midpoint is done here without rounding error:
    the fraction is cut into two parts short enough for exact products.
    """
    given = F.col(column).cast("double")
    x = f"if(abs(`{column}`) < {_LARGE}D, `{column}`, 0D)"
    size = f"abs({x})"
    fraction = f"({size} - floor({size}))"
    tenths = f"floor({fraction} * 10)"
    high = f"(floor({fraction} * 67108864D) / 67108864D)"  # the first 26 bits
    past = f"({high} * 20 - ({tenths} * 2 + 1) + ({fraction} - {high}) * 20)"
    up = f"if({past} > 0 OR ({past} = 0 AND {tenths} % 2 = 1), 1, 0)"
    rounded = f"(floor({size}) * 10 + {tenths} + {up})"
    usual = F.expr(f"concat(if({x} < 0, '-', ''), {rounded} div 10, '.', {rounded} % 10)")
    whole = F.concat(given.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.when(given.isNull(), None).otherwise(F.coalesce(_unusual(given, whole), usual))


def grouped_int(value: Column) -> Column:
    """Whole part with thousands separators."""
    given = value.cast("double")
    usual = F.format_number(F.when(F.abs(given) < _LARGE, given).otherwise(0.0).cast("long"), 0)
    whole = F.format_number(given.try_cast("decimal(38,0)"), 0)
    return F.when(given.isNull(), None).otherwise(F.coalesce(_unusual(given, whole), usual))


def or_na(value: Column, text: Column) -> Column:
    """``text`` where the measurement exists; missing, NaN and 0.0 read N/A."""
    return F.when(value.isNull() | F.isnan(value) | (value == 0.0), F.lit("N/A")).otherwise(text)
