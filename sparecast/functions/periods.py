"""Month arithmetic around an explicit ``as_of`` date.

The jobs never read the clock: every window is derived from ``as_of``.  Bounds
are computed once on the driver from that literal (pure calendar arithmetic, no
data), so Catalyst sees constants and pushes the predicates into the scan.

A window ``(n, m)`` covers whole months from the first day of month ``-(n-1)``
to the last day of month ``-m`` relative to the month of ``as_of``.  It is
applied half-open (``>= first day`` and ``< first day after the window``) so it
is correct for DATE and TIMESTAMP columns alike.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date(value) -> _dt.date:
    """Accept a ``date``, ``datetime`` or ISO text and return a ``date``."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def month_start(as_of, offset: int = 0) -> _dt.date:
    """First day of the month ``offset`` months away from the month of ``as_of``."""
    d = to_date(as_of)
    y, m = divmod(d.year * 12 + (d.month - 1) + offset, 12)
    return _dt.date(y, m + 1, 1)


def month_window(as_of, n: int, m: int) -> tuple[_dt.date, _dt.date]:
    """Half-open bounds ``[start, end)`` of the whole-month window ``(n, m)``.

    ``n=13, m=1`` with ``as_of=2000-12-15`` gives ``[1999-12-01, 2000-12-01)``:
    twelve whole months ending with the month before ``as_of``.
    """
    if n < m:
        raise ValueError(f"window start month -{n} is after end month -{m}")
    return month_start(as_of, -(n - 1)), month_start(as_of, -(m - 1))


def in_month_window(column: str | Column, as_of, n: int, m: int) -> Column:
    """Predicate: ``column`` falls inside the whole-month window ``(n, m)``."""
    c = F.col(column) if isinstance(column, str) else column
    start, end = month_window(as_of, n, m)
    return (c >= F.lit(start)) & (c < F.lit(end))


def horizon_months(as_of, horizon: int = 12, first_offset: int = 1) -> list[_dt.date]:
    """First days of the ``horizon`` months starting ``first_offset`` months after ``as_of``."""
    return [month_start(as_of, first_offset + i) for i in range(horizon)]


def run_date(as_of) -> _dt.date:
    """Run date stamped on published rows: the 3rd of the month of ``as_of``."""
    return to_date(as_of).replace(day=3)


def month_label(column: str | Column) -> Column:
    """``MMM-yy`` text of a date (``Nov-24``), the key of the plan file."""
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "MMM-yy")


# The month names of the plan file (English, whatever the locale).
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_label_of(d) -> str:
    """Driver-side ``MMM-yy`` label of a literal date."""
    day = to_date(d)
    return f"{MONTH_NAMES[day.month - 1]}-{day.year % 100:02d}"


def first_of_month(column: str | Column) -> Column:
    """Snap a date or timestamp to the first day of its month, as DATE."""
    c = F.col(column) if isinstance(column, str) else column
    return F.trunc(c.cast("date"), "MM")
