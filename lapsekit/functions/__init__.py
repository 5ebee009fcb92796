"""Column functions (JVM-side expressions, no Python UDFs)."""

from lapsekit.functions.periods import (
    quarter_start,
    quarter_label,
    period_start,
    period_label,
    period_end,
    period_index,
    periods_of,
    Period,
)
from lapsekit.functions.text import trim_ws, norm_key, norm_code
from lapsekit.functions.rates import rate

__all__ = [
    "quarter_start", "quarter_label", "period_start", "period_label", "period_end",
    "period_index", "periods_of", "Period", "trim_ws", "norm_key", "norm_code", "rate",
]
