"""Ratios and conditional counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(num, den, digits: int = 4) -> Column:
    """``ROUND(SAFE_DIVIDE(num, den), digits)`` as DOUBLE; NULL on a zero denominator."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)
