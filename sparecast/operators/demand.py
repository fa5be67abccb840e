"""Segment demand from invoice lines (window, segment filter, dedup, sums).

The original jobs select ``(part, date, int qty, value)`` lines with a
``GROUP BY`` that has no aggregate, i.e. a DISTINCT: two invoice lines with the
same part, day, quantity and value count once.  ``dedup=True`` (default)
reproduces that; ``dedup=False`` sums every line.

Plan shape: the window and segment predicates reach the scan; the DISTINCT is
an aggregate over the line columns (partial dedup before the shuffle), and the
sums are a second partial+final aggregate.  A part that holds a third of all
lines is combined map-side by the partial aggregate, so no task receives its
raw lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import first_of_month, in_month_window, month_window

PARTS_TYPE = "Parts"


@dataclass(frozen=True)
class MonthStates:
    """Demand per month in place of invoice lines (see ``operators.months``): every function here takes either.

    ``parts`` has ``industry, Part_Id, month, qty, value`` and ``dealers`` the
    dealer and country too.  Windows are whole months, so a condition on the
    day (``LeoDate``) holds for all days of a month or none.
    """

    parts: DataFrame
    dealers: DataFrame
    dedup: bool = True
    #: ``industry, Part_Id, first_month``: the parts each segment ever billed.
    segments: DataFrame | None = None

    @property
    def sparkSession(self):
        return self.parts.sparkSession

    def rows(self, as_of, n: int, m: int, segment: str | Sequence[str] | None, by: Sequence[str], dedup: bool,
             dealers: bool = False, line_type: str | None = PARTS_TYPE, line_filter: F.Column | None = None) -> DataFrame:
        """The month rows of a window, with ``LeoDate`` for the month."""
        if dedup != self.dedup or line_type != PARTS_TYPE:
            raise ValueError("the month tables were made with other rules (repeated lines, line type)")
        if not isinstance(segment, str) and "industry" not in by:
            raise ValueError("month tables keep segments apart: name one segment, or group by industry")
        if {"DealerID", "country"} & set(by) and not dealers:
            raise ValueError("the month tables hold dealers only for lines with a dealer and a country")
        held = self.dealers if dealers else self.parts
        cond = in_month_window("month", as_of, n, m)
        if segment is not None:
            cond = cond & segment_filter(segment)
        found = held.where(cond).withColumnRenamed("month", "LeoDate")
        return found if line_filter is None else found.where(line_filter)


def segment_filter(segment: str | Sequence[str]) -> F.Column:
    """``industry = segment``, or ``industry IN (...)`` for several segments."""
    if isinstance(segment, str):
        return F.col("industry") == F.lit(segment)
    return F.col("industry").isin(*segment)


def billing_lines(billing: DataFrame, as_of, n: int, m: int, segment: str | Sequence[str] | None,
                  line_type: str | None = PARTS_TYPE) -> DataFrame:
    """Invoice lines of ``segment`` (one or several) inside the whole-month window ``(n, m)``.

    Columns: ``Part_Id, DealerID, country, LeoDate (DATE), qty (INT), value,
    industry``.  The quantity is truncated to an integer before anything else.
    """
    cond = in_month_window("BillingDate", as_of, n, m)
    if segment is not None:
        cond = cond & segment_filter(segment)
    if line_type is not None:
        cond = cond & (F.col("Type") == F.lit(line_type))
    return billing.where(cond).select(
        F.col("MaterialNumber").alias("Part_Id"),
        F.col("DealerID"),
        F.col("country"),
        F.col("BillingDate").cast("date").alias("LeoDate"),
        F.col("BilledQuantity").cast("int").alias("qty"),
        F.col("BilledValue").alias("value"),
        F.col("industry"),
    )


def segment_demand(billing: DataFrame, as_of, n: int, m: int, segment: str | Sequence[str] | None,
                   by: Sequence[str] = ("Part_Id",), monthly: bool = False,
                   dedup: bool = True, require_dealer_country: bool = False,
                   line_type: str | None = PARTS_TYPE, line_filter: F.Column | None = None) -> DataFrame:
    """Sum of quantity and value per ``by`` keys (plus ``start_of_month`` if ``monthly``).

    ``by`` may name ``industry``, ``Part_Id``, ``DealerID`` and ``country``
    (``industry`` keeps several segments apart in one pass).  With
    ``require_dealer_country`` lines with an empty/NULL country or a NULL dealer
    are dropped (the dealer/country split needs both).  ``line_filter`` is an
    extra predicate on the lines (e.g. a window per segment).
    Output: ``*by, [start_of_month], qty (BIGINT), value``.
    """
    keys = [F.col(k) for k in by]
    if monthly:
        keys.append(first_of_month("LeoDate").alias("start_of_month"))
    if isinstance(billing, MonthStates):
        rows = billing.rows(as_of, n, m, segment, by, dedup, require_dealer_country, line_type, line_filter)
        return rows.groupBy(*keys).agg(F.sum("qty").cast("bigint").alias("qty"),
                                       F.sum("value").cast(rows.schema["value"].dataType).alias("value"))
    lines = billing_lines(billing, as_of, n, m, segment, line_type)
    if line_filter is not None:
        lines = lines.where(line_filter)
    if require_dealer_country:
        lines = lines.where((F.col("country") != F.lit("")) & F.col("DealerID").isNotNull())
    lines = lines.select(*by, "LeoDate", "qty", "value")
    if dedup:
        lines = lines.distinct()
    return lines.groupBy(*keys).agg(
        F.sum("qty").cast("bigint").alias("qty"),
        F.sum("value").alias("value"),
    )


def active_month_demand(billing: DataFrame, as_of, n: int, m: int, segment: str | Sequence[str],
                        by: Sequence[str] = ("Part_Id",), dedup: bool = True,
                        line_filter: F.Column | None = None) -> DataFrame:
    """``*by, _t, Months_Count``: the quantity of a part in the window and its months with a line.

    Every line sets the bit of its month; the bits are OR-ed with the sums, so
    the months need no grouping of their own.  Windows of up to 63 months.
    """
    first, end = month_window(as_of, n, m)
    months = (end.year - first.year) * 12 + end.month - first.month
    if months > 63:
        raise ValueError(f"a window of {months} months has no room in the month bits")
    if isinstance(billing, MonthStates):  # one row per part and month
        rows = billing.rows(as_of, n, m, segment, by, dedup, line_filter=line_filter)
        return rows.groupBy(*by).agg(F.sum("qty").cast("bigint").alias("_t"), F.count(F.lit(1)).alias("Months_Count"))
    lines = billing_lines(billing, as_of, n, m, segment)
    if line_filter is not None:
        lines = lines.where(line_filter)
    lines = lines.select(*by, "LeoDate", "qty", "value")
    if dedup:
        lines = lines.distinct()
    month = (F.year("LeoDate") - first.year) * 12 + F.month("LeoDate") - first.month
    lines = lines.withColumn("_bit", F.call_function("shiftleft", F.lit(1).cast("bigint"), month))
    return lines.groupBy(*by).agg(
        F.sum("qty").cast("bigint").alias("_t"),
        F.bit_count(F.bit_or("_bit")).cast("bigint").alias("Months_Count"),
    )


def monthly_demand(billing: DataFrame, as_of, n: int, m: int, segment: str,
                   dedup: bool = True) -> DataFrame:
    """Demand per part and month: ``Part_Id, start_of_month, qty, value``."""
    return segment_demand(billing, as_of, n, m, segment, monthly=True, dedup=dedup)


def dealer_demand(billing: DataFrame, as_of, n: int, m: int, segment: str,
                  dedup: bool = True) -> DataFrame:
    """Demand per part, dealer and country: ``Part_Id, DealerID, country, qty, value``."""
    return segment_demand(billing, as_of, n, m, segment, by=("Part_Id", "DealerID", "country"),
                          dedup=dedup, require_dealer_country=True)


def dealer_key(dealer: str = "DealerID", country: str = "country") -> F.Column:
    """``dealer_country`` text key (NULL if either part is NULL)."""
    return F.concat(F.col(dealer).cast("string"), F.lit("_"), F.col(country))


def split_dealer_key(key: str = "DealerID_country") -> tuple[F.Column, F.Column]:
    """Split a ``dealer_country`` key at ``_``: first and second piece.

    A country that itself contains ``_`` is cut; the operators therefore keep
    dealer and country as two columns and use this only for keyed text input.
    """
    parts = F.split(F.col(key), "_")
    return F.get(parts, 0), F.get(parts, 1)
