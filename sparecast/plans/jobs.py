"""The monthly jobs, end to end, over catalog tables.

Each job reads its inputs (tables, Parquet paths, CSV files or DataFrames),
runs the operators and writes one table; the next job reads that table back.
Every job takes ``as_of`` explicitly.

    classify    billing + dispatch            -> class table      (all segments, by industry)
    forecast    billing + master + class + plan -> part forecast  (all segments, by industry, month)
    apportion   billing + part forecasts + master -> dealer forecast (all segments, by order_date)
    publish     dealer forecast                -> published table (append, backup, counts)

Every step handles all segments in one pass: the segment is a grouping key, so
the invoice lines are read once per step instead of once per segment.  Where
the segments' windows differ (prices, base demand), the widest window is read
once and each segment keeps its own months.
    upload      manual CSV                     -> published table (replace by key)
    backtest    billing + master + class + plan -> accuracy
    monthly_inputs published + dispatch + billing -> accuracy inputs
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import run_date as run_date_of
from ..operators import accuracy as acc
from ..operators import apportion as ap
from ..operators import classify as cl
from ..operators import forecast as fc
from ..operators import months as months_of_lines
from ..operators import publish as pb
from ..operators.demand import MonthStates
from ..sources import csv as csv_src
from ..sources import sinks
from ..sources.tables import read_billing, read_dispatch, read_table


def _frame(spark: SparkSession, source, reader=None) -> DataFrame:
    """DataFrame, catalog table, Parquet path, or (with ``reader``) a CSV path."""
    if isinstance(source, DataFrame):
        return source
    if reader is not None and str(source).lower().endswith(".csv"):
        return reader(spark, str(source))
    return read_table(spark, source)


@dataclass
class Sources:
    """Where the inputs live (any form :func:`_frame` accepts)."""

    billing: object
    dispatch: object
    master: object
    plan: object
    exclude_text: str = fc.EXCLUDED_PART_TEXT
    #: Canonical column -> the source's own column, where they differ.
    billing_columns: dict[str, str] | None = None
    dispatch_columns: dict[str, str] | None = None
    #: Monthly partial aggregates (kept up by :func:`close_months`) that the demand steps read instead of the lines.
    months: months_of_lines.MonthTables | None = None

    def demand(self, spark: SparkSession) -> DataFrame | MonthStates:
        """What the demand steps read: the month tables if there are any, else the invoice lines."""
        lines = self.billing_lines(spark)
        return months_of_lines.month_states(spark, self.months, lines=lines) if self.months else lines

    def billing_lines(self, spark: SparkSession) -> DataFrame:
        return read_billing(spark, _frame(spark, self.billing), self.billing_columns)

    def dispatch_lines(self, spark: SparkSession) -> DataFrame:
        return read_dispatch(spark, _frame(spark, self.dispatch), self.dispatch_columns)


@dataclass
class Tables:
    """Names of the tables the jobs write."""

    prefix: str = "planning"
    published: str = "planning_published"
    backup: str | None = "planning_published_backup"

    @property
    def classes(self) -> str:
        """Class table of all segments, partitioned by ``industry``."""
        return f"{self.prefix}_abc_fms"

    @property
    def part_forecasts(self) -> str:
        """Part forecast of all segments, partitioned by ``industry`` and month."""
        return f"{self.prefix}_part_forecast"

    def part_forecast(self, spark: SparkSession, segment: str) -> DataFrame:
        """One segment's part forecast (partitions of :attr:`part_forecasts`)."""
        return spark.table(self.part_forecasts).where(F.col("industry") == segment)

    @property
    def dealer_forecast(self) -> str:
        """Dealer/country forecast of all segments, partitioned by ``order_date``."""
        return f"{self.prefix}_dealer_forecast"

    def class_table(self, spark: SparkSession, segment: str) -> DataFrame:
        """One segment's class table (a partition of :attr:`classes`)."""
        return spark.table(self.classes).where(F.col("industry") == segment).drop("industry")


def close_months(spark: SparkSession, src: Sources, as_of, since=None, late: DataFrame | None = None) -> list:
    """Add the closed months that ``src.months`` doesn't hold yet, and those of ``late`` lines; returns them."""
    return months_of_lines.close_months(spark, src.billing_lines(spark), src.months, as_of, since, late)


def classify(spark: SparkSession, src: Sources, tables: Tables, as_of,
             segments=("2W", "3W")) -> DataFrame:
    """Write the class table of all segments (one pass over the invoice lines and
    one over the dispatches); return the category counts per segment (lazy)."""
    billing = src.demand(spark)
    dispatch = src.dispatch_lines(spark)
    sinks.write_table(cl.classify_segments(billing, dispatch, as_of, segments), tables.classes,
                      partition_by="industry")
    return spark.table(tables.classes).groupBy("industry", "categorisation").agg(F.count(F.lit(1)).alias("count"))


def forecast(spark: SparkSession, src: Sources, tables: Tables, as_of, segments=("2W", "3W")) -> None:
    """Write the 12-month part forecast of all segments (one scan of the invoice
    lines over the widest demand window; each segment keeps its own months),
    partitioned by segment and month."""
    segments = tuple(segments)
    billing = src.demand(spark)
    master = _frame(spark, src.master, csv_src.read_parts_master)
    plan = _frame(spark, src.plan, csv_src.read_plan)
    base = fc.base_demand_segments(billing, master, spark.table(tables.classes), as_of, segments,
                                   exclude_text=src.exclude_text)
    sinks.write_table(fc.plan_forecast(base, plan, as_of, segments), tables.part_forecasts,
                      partition_by=["industry", "Forecast_month"])


def apportion(spark: SparkSession, src: Sources, tables: Tables, as_of, segments=("2W", "3W")) -> None:
    """Write the dealer/country forecast of all segments in the publish layout
    (one pass over the invoice lines for the ratios), partitioned by order date."""
    segments = tuple(segments)
    billing = src.demand(spark)
    master = _frame(spark, src.master, csv_src.read_parts_master)
    forecasts = spark.table(tables.part_forecasts).where(F.col("industry").isin(*segments))
    ratios = ap.dealer_ratios(billing, as_of, segments)
    dealer = ap.apportion(forecasts, ratios)
    sinks.write_table(pb.format_publish(dealer, master, as_of, segments), tables.dealer_forecast,
                      partition_by="order_date")


def publish(spark: SparkSession, tables: Tables, mode: str = "append", segments=None, as_of=None) -> sinks.WriteReport:
    """Write the dealer forecast of all segments to the published table (backup of the touched months first).

    ``mode="append"`` as the original jobs; ``"append_once"`` publishes a run with the
    same rows once only; ``"replace_run"`` makes a rerun
    idempotent: the earlier rows of the run of ``as_of`` and of ``segments`` go,
    also where the forecast has no such rows any more.
    """
    run = run_date_of(as_of) if as_of is not None else None
    return pb.publish(spark.table(tables.dealer_forecast), tables.published, tables.backup, mode, segments, run, backup_scope="touched")


def upload(spark: SparkSession, tables: Tables, upload_source, date_pattern: str = "yy/MM/dd") -> sinks.WriteReport:
    """Apply a manual upload (CSV path or DataFrame) to the published table by key."""
    up = _frame(spark, upload_source, csv_src.read_upload)
    return pb.replace_by_key_table(up, tables.published, date_pattern)


def backtest(spark: SparkSession, src: Sources, tables: Tables, as_of, segment: str = "2W",
             plan_value: float | None = None) -> DataFrame:
    """Accuracy of last month's forecast from history ending two months back
    (``plan_value``: that month's plan, instead of the plan's rows)."""
    billing = src.demand(spark)
    master = _frame(spark, src.master, csv_src.read_parts_master)
    plan = _frame(spark, src.plan, csv_src.read_plan)
    rows = acc.backtest_rows(billing, master, tables.class_table(spark, segment), plan, as_of, segment,
                             exclude_text=src.exclude_text, plan_value=plan_value)
    return acc.accuracy(rows)


def monthly_inputs(spark: SparkSession, src: Sources, tables: Tables, as_of, run_date, order_date,
                   segment: str = "2W") -> dict[str, DataFrame]:
    """Published demand of one run and month, monthly actuals, dealer unit prices."""
    billing = src.demand(spark)
    dispatch = src.dispatch_lines(spark)
    return {
        "published_demand": acc.published_demand(spark.table(tables.published), run_date, order_date),
        "monthly_actuals": acc.monthly_actuals(dispatch, billing, as_of, segment),
        "dealer_unit_price": acc.dealer_unit_price(dispatch, as_of),
    }


def run_month(spark: SparkSession, src: Sources, tables: Tables, as_of,
              segments=("2W", "3W"), mode: str = "append") -> sinks.WriteReport:
    """Classification, forecast and split, each one pass over all segments, then
    one publish of all segments."""
    classify(spark, src, tables, as_of, segments)
    forecast(spark, src, tables, as_of, segments)
    apportion(spark, src, tables, as_of, segments)
    return publish(spark, tables, mode, segments, as_of)
