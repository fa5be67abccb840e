"""Monthly partial aggregates of the invoice lines.

Classification, base demand, ratios and back-test read overlapping windows of
whole months, six to twelve each.  Lines count once per part, day, quantity and value, and the day
lies in one month, so the demand of a window is exactly the sum of the
demands of its months.  Two tables hold these, written once per closed month
and partitioned by ``month``, and a third which parts each segment ever billed:

* ``<prefix>_part_months``: industry, Part_Id, month, qty, value;
* ``<prefix>_dealer_months``: industry, Part_Id, DealerID, country, month, qty,
  value (lines with a dealer and a country; lines that two dealers have in common count
  for each of them here and once above, which is why there are two tables);
* ``<prefix>_part_segments``: industry, Part_Id, partitioned by ``first_month``, the
  first closed month with a line.  A closed month adds the parts that no earlier one
  has; a reopened one replaces the entries from that month on, out of the month table.

:class:`sparecast.operators.demand.MonthStates` stands in for the invoice lines
in all demand operators.  A new month reads the lines of that month only;
late lines reopen the months they fall into.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import first_of_month, month_start
from ..sources import sinks
from .demand import PARTS_TYPE, MonthStates

PART_KEYS = ("industry", "Part_Id")
DEALER_KEYS = ("industry", "Part_Id", "DealerID", "country")


@dataclass(frozen=True)
class MonthTables:
    """Names of the tables."""

    prefix: str = "planning"

    @property
    def parts(self) -> str:
        return f"{self.prefix}_part_months"

    @property
    def dealers(self) -> str:
        return f"{self.prefix}_dealer_months"

    @property
    def segments(self) -> str:
        return f"{self.prefix}_part_segments"


def in_months(column: str, months: Iterable[dt.date]) -> Column:
    """Whether a date falls into one of the months: half-open ranges, one per run of consecutive months."""
    found: Column | None = None
    wanted = sorted({month_start(m) for m in months})
    while wanted:
        first = end = wanted[0]
        while wanted and wanted[0] == end:
            end = month_start(wanted.pop(0), 1)
        span = (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(end))
        found = span if found is None else found | span
    return F.lit(False) if found is None else found


def month_demand(billing: DataFrame, months: Iterable[dt.date], keys: tuple[str, ...], dedup: bool = True) -> DataFrame:
    """``*keys, qty, value, month`` of the lines in the given months."""
    rows = billing.where(in_months("BillingDate", months) & (F.col("Type") == F.lit(PARTS_TYPE)))
    lines = rows.select(
        F.col("industry"), F.col("MaterialNumber").alias("Part_Id"), F.col("DealerID"), F.col("country"),
        F.col("BillingDate").cast("date").alias("LeoDate"), F.col("BilledQuantity").cast("int").alias("qty"),
        F.col("BilledValue").alias("value"))
    if "DealerID" in keys:
        lines = lines.where((F.col("country") != F.lit("")) & F.col("DealerID").isNotNull())
    lines = lines.select(*keys, "LeoDate", "qty", "value")
    if dedup:
        lines = lines.distinct()
    month = first_of_month("LeoDate").alias("month")
    return lines.groupBy(*keys, month).agg(F.sum("qty").cast("bigint").alias("qty"), F.sum("value").alias("value")).select(
        *keys, "qty", "value", "month")


def held_months(spark: SparkSession, tables: MonthTables) -> set[dt.date]:
    """The months that both month tables hold (from the catalog)."""
    held = None
    for name in (tables.parts, tables.dealers):
        if not sinks.table_exists(spark, name):
            return set()
        own = {dt.date.fromisoformat(v) for v in sinks.partition_values(spark, name)}
        held = own if held is None else held & own
    return held or set()


def months_of(lines: DataFrame, column: str = "BillingDate") -> set[dt.date]:
    """The months of some lines (one row per month comes back)."""
    rows = lines.where(F.col(column).isNotNull()).select(first_of_month(column).alias("month")).distinct()
    return {r["month"] for r in rows.toLocalIterator()}


def refresh(spark: SparkSession, billing: DataFrame, tables: MonthTables, months: Iterable[dt.date], dedup: bool = True) -> None:
    """Compute the given months anew, in all tables; the lines of other months are not read.

    Each table is staged and then overwritten by partition, so an interruption is
    finished by the next call (``sinks.recover``) or the month is computed again.
    The dealers' table comes last: only with it a month is held.
    """
    months = sorted({month_start(m) for m in months})
    if not months:
        return
    days = {m.isoformat() for m in months}
    _replace_months(spark, month_demand(billing, months, PART_KEYS, dedup), tables.parts, "month", days)
    sinks.recover(spark, tables.segments)
    known = spark.table(tables.segments) if sinks.table_exists(spark, tables.segments) else None
    later = set(sinks.partition_values(spark, tables.segments)) if known is not None else set()
    first = first_months(spark.table(tables.parts), known, months[0] if later else None)
    _replace_months(spark, first, tables.segments, "first_month", {d for d in later if d >= months[0].isoformat()})
    _replace_months(spark, month_demand(billing, months, DEALER_KEYS, dedup), tables.dealers, "month", days)


def first_months(parts: DataFrame, known: DataFrame | None, since: dt.date | None) -> DataFrame:
    """``industry, Part_Id, first_month`` of the parts whose first month is ``since`` or later.

    ``known`` holds the entries before ``since``, which later months cannot change; of the
    month table only the months from ``since`` on are read (all without it).
    """
    if since is not None:
        parts = parts.where(F.col("month") >= F.lit(since))
    first = parts.groupBy(*PART_KEYS).agg(F.min("month").alias("first_month"))
    if since is None or known is None:
        return first
    before = known.where(F.col("first_month") < F.lit(since)).select(*[F.col(k).alias(f"known_{k}") for k in PART_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in PART_KEYS]
    return first.join(before, same[0] & same[1], "left_anti")


def _replace_months(spark: SparkSession, rows: DataFrame, name: str, column: str, days: set[str]) -> None:
    """Put ``rows`` in place of the partitions they have and of those of ``days``, which go where no row is left."""
    sinks.recover(spark, name)
    sinks.create_empty_table(spark, name, rows.schema, partition_by=column, sort_by=list(PART_KEYS))
    sinks.write_table(rows, name + sinks.STAGE)  # the replace deals the rows by month: once is enough
    filled = {str(r[0]) for r in spark.table(name + sinks.STAGE).select(column).distinct().toLocalIterator()}
    if filled:
        sinks.finish_stage(spark, name, column)
    else:
        sinks.drop_table(spark, name + sinks.STAGE)
    for day in sorted(days - filled):  # all its rows are gone
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = DATE'{day}')")


def close_months(spark: SparkSession, billing: DataFrame, tables: MonthTables, as_of, since=None, late: DataFrame | None = None,
                 dedup: bool = True) -> list[dt.date]:
    """Bring the tables up to the month before ``as_of``, from the month of ``since`` on; returns the months computed.

    Without ``since`` from the first month of all lines (only their dates are read for it).

    Only months that aren't held are read, and those of ``late``: lines that came
    after their month was closed (they are part of ``billing`` too).
    """
    first, end = month_start(since) if since is not None else min(months_of(billing), default=month_start(as_of)), month_start(as_of)
    wanted = set()
    month = first
    while month < end:
        wanted.add(month)
        month = month_start(month, 1)
    todo = wanted - held_months(spark, tables)
    if late is not None:
        todo |= months_of(late) & wanted
    refresh(spark, billing, tables, todo, dedup)
    return sorted(todo)


def month_states(spark: SparkSession, tables: MonthTables, dedup: bool = True, lines: DataFrame | None = None) -> MonthStates:
    """What stands in for the invoice lines in the demand operators.

    With ``lines`` (all invoice lines), the index of parts counts the months that aren't held too, of which only those lines are read.
    """
    index = spark.table(tables.segments) if sinks.table_exists(spark, tables.segments) else None
    if index is not None and lines is not None:
        held = in_months("BillingDate", held_months(spark, tables))
        others = lines.where((~held | F.col("BillingDate").isNull()) & (F.col("Type") == F.lit(PARTS_TYPE)))
        index = index.unionByName(others.select(
            "industry", F.col("MaterialNumber").alias("Part_Id"), first_of_month("BillingDate").alias("first_month")))
    return MonthStates(spark.table(tables.parts), spark.table(tables.dealers), dedup, index)

