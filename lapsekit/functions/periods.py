"""Period arithmetic (F1, F2 and their grain-generic forms).

All of these are Catalyst expressions; a period index is computed by
arithmetic on the date, so no join to a period dimension is needed to place an
event in the spine.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRUNC = {"quarter": "quarter", "month": "month", "week": "week"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quarter_start(c) -> Column:
    """first day of the calendar quarter of a DATE (NULL in, NULL out)."""
    return F.trunc(_col(c), "quarter")


def quarter_label(c) -> Column:
    """``YYYYQn`` label of the calendar quarter of a DATE (NULL in, NULL out)."""
    c = _col(c)
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def period_start(c, grain: str = "quarter") -> Column:
    return F.trunc(_col(c), _TRUNC[grain])


def period_label(c, grain: str = "quarter") -> Column:
    c = _col(c)
    if grain == "quarter":
        return quarter_label(c)
    if grain == "month":
        return F.date_format(c, "yyyy-MM")
    if grain == "week":
        return F.date_format(F.trunc(c, "week"), "yyyy-MM-dd")
    raise ValueError(f"unknown grain {grain!r}")


def period_end(start, grain: str = "quarter") -> Column:
    """Last day of the period that begins at ``start``."""
    s = _col(start)
    if grain == "quarter":
        return F.date_sub(F.add_months(s, 3), 1)
    if grain == "month":
        return F.date_sub(F.add_months(s, 1), 1)
    if grain == "week":
        return F.date_add(s, 6)
    raise ValueError(f"unknown grain {grain!r}")


def period_index(c, first_start: dt.date, grain: str = "quarter") -> Column:
    """1-based index of the period of ``c`` counted from the period starting at ``first_start``."""
    c = _col(c)
    if grain == "quarter":
        base = first_start.year * 4 + (first_start.month - 1) // 3
        return (F.year(c) * 4 + F.quarter(c) - 1 - F.lit(base) + 1).cast("long")
    if grain == "month":
        base = first_start.year * 12 + first_start.month - 1
        return (F.year(c) * 12 + F.month(c) - 1 - F.lit(base) + 1).cast("long")
    if grain == "week":
        return (F.floor(F.datediff(F.trunc(c, "week"), F.lit(first_start)) / 7) + 1).cast("long")
    raise ValueError(f"unknown grain {grain!r}")


@dataclass(frozen=True)
class Period:
    label: str
    start: dt.date
    end: dt.date
    index: int
    complete: bool = True        # wholly inside the analysis range


def _add_months(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    return dt.date(d.year + m // 12, m % 12 + 1, 1)


def _floor(d: dt.date, grain: str) -> dt.date:
    if grain == "quarter":
        return dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
    if grain == "month":
        return dt.date(d.year, d.month, 1)
    if grain == "week":
        return d - dt.timedelta(days=d.weekday())
    raise ValueError(f"unknown grain {grain!r}")


def _label(d: dt.date, grain: str) -> str:
    if grain == "quarter":
        return f"{d.year}Q{(d.month - 1) // 3 + 1}"
    if grain == "month":
        return f"{d.year}-{d.month:02d}"
    return d.isoformat()


def periods_of(start: dt.date, end: dt.date, grain: str = "quarter") -> list[Period]:
    """The analysis periods as plain values (a function of the parameters only;
    its length is bounded by the period range, never by the data)."""
    out, s, i = [], _floor(start, grain), 1
    while s <= end:
        if grain == "quarter":
            nxt = _add_months(s, 3)
        elif grain == "month":
            nxt = _add_months(s, 1)
        else:
            nxt = s + dt.timedelta(days=7)
        last = nxt - dt.timedelta(days=1)
        out.append(Period(_label(s, grain), s, last, i, start <= s and last <= end))
        s, i = nxt, i + 1
    return out
