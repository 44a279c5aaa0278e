"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_number(text: Column) -> Column:
    """One spelling per number: '2560.0', '2560.00', '02560' all become '2560'.

    Rounded to six decimals, trailing zeros and a bare point removed. Text that is no number
    stays as it is. Text without a digit is not even tried: a failing cast costs an exception.
    """
    fixed = text.try_cast("decimal(38,6)").cast("string")
    trimmed = F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit("."))
    return F.when(text.rlike(r"\p{Nd}"), F.coalesce(trimmed, text)).otherwise(text)


def safe_ratio(top: Column, bottom: Column, scale: int = 1) -> Column:
    """top / (bottom * scale) as double; NULL when the divisor is zero.

    The divisor is widened before it is multiplied: ANSI integers raise on overflow.
    """
    wide = bottom.cast("decimal(28,6)") * F.lit(scale).cast("decimal(10,0)")
    return F.try_divide(top.cast("double"), wide.cast("double"))
