"""Forecast accuracy: the one-month back-test and the monthly accuracy inputs.

Back-test: base demand over 8 whole months ending two months back, forecast
for last month with the back-test weights and that month's plan, compared
with last month's actual demand of active parts.
Accuracy is ``1 - sum |actual - forecast| / sum actual`` (1 - WAPE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import BACKTEST_WEIGHTS, EXCLUDED_PART_TEXT, safe_div
from ..functions.periods import month_label_of, month_start
from .demand import MonthStates, monthly_demand
from .forecast import active_parts, base_demand, forecast_frame
from .pricing import dispatch_lines, unit_price

BACKTEST_HISTORY = (10, 2)
BACKTEST_ACTUAL = (2, 1)


def backtest_rows(billing: DataFrame, master: DataFrame, class_table: DataFrame, plan: DataFrame,
                  as_of, segment: str = "2W", weights: dict | None = None,
                  history: tuple[int, int] = BACKTEST_HISTORY,
                  actual: tuple[int, int] = BACKTEST_ACTUAL,
                  exclude_text: str | None = EXCLUDED_PART_TEXT,
                  dedup_master: bool = False, plan_value: float | None = None) -> DataFrame:
    """Per part: actual quantity of the test month, forecast, absolute error.

    ``plan_value`` is the money plan of the test month; without it the month's
    rows of ``plan`` are summed.

    Output: ``Part_Id, start_of_month, qty, Forecast_month, Rounded_Qty,
    Absolute_error``.  The actuals are joined with the master without
    de-duplication (unless ``dedup_master``), like the forecast side.
    """
    base = base_demand(billing, master, class_table, as_of, segment, window=history,
                       weights=weights or BACKTEST_WEIGHTS, exclude_text=exclude_text,
                       dedup_master=dedup_master)
    test_offset = -actual[1]
    if plan_value is not None:
        label = month_label_of(month_start(as_of, test_offset))
        plan = billing.sparkSession.createDataFrame([(label, segment, float(plan_value))], "Month string, Type string, Plan double")
    fc = forecast_frame(base, plan, as_of, segment, horizon=1, first_offset=test_offset).select(
        "Part_Id", "Forecast_month", "Rounded_Qty")
    n, m = actual
    parts = active_parts(master, segment, exclude_text)
    act = monthly_demand(billing, as_of, n, m, segment).join(
        parts.distinct() if dedup_master else parts, "Part_Id")
    return act.join(fc, "Part_Id").select(
        "Part_Id", "start_of_month", "qty", "Forecast_month", "Rounded_Qty",
        F.abs(F.col("qty").cast("double") - F.col("Rounded_Qty")).alias("Absolute_error"),
    )


def accuracy(rows: DataFrame) -> DataFrame:
    """One row: ``sum_abs_error, sum_actual, sum_forecast, accuracy, parts``."""
    agg = rows.agg(
        F.sum("Absolute_error").alias("sum_abs_error"),
        F.sum("qty").cast("bigint").alias("sum_actual"),
        F.sum("Rounded_Qty").alias("sum_forecast"),
        F.countDistinct("Part_Id").alias("parts"),
    )
    return agg.select(
        "sum_abs_error", "sum_actual", "sum_forecast",
        (F.lit(1.0) - safe_div(F.col("sum_abs_error"), F.col("sum_actual").cast("double"))).alias("accuracy"),
        "parts",
    )


def published_demand(published: DataFrame, run_date, order_date) -> DataFrame:
    """Published quantity of one run for one order month, per part and country."""
    return (
        published.where((F.col("run_date") == F.lit(run_date)) & (F.col("order_date") == F.lit(order_date)))
        .groupBy("order_date", F.col("part_id").alias("Part_Id"), F.col("country").alias("Country"))
        .agg(F.sum("order_qty").alias("forecast_qty"))
    )


def segment_parts(billing: DataFrame, segment: str, wanted: DataFrame, line_type: str = "Parts") -> DataFrame:
    """The parts (``Part_Id``) of ``wanted`` that were ever billed in ``segment``.

    The whole billing history is filtered to the wanted parts (one month's
    dispatches) before the DISTINCT, so only their lines are shuffled for it.
    With month tables (over all history) their index of parts is read instead of the lines.
    """
    if isinstance(billing, MonthStates):
        held = billing.parts if billing.segments is None else billing.segments
        billed = held.where(F.col("industry") == F.lit(segment)).select("Part_Id")
    else:
        billed = billing.where((F.col("industry") == F.lit(segment)) & (F.col("Type") == F.lit(line_type))).select(
            F.col("MaterialNumber").alias("Part_Id"))
    return (
        billed
        .join(wanted.select("Part_Id").distinct(), "Part_Id", "left_semi")
        .distinct()
    )


def dispatch_in_segment(dispatch: DataFrame, billing: DataFrame, as_of, segment: str,
                        window: tuple[int, int] = BACKTEST_ACTUAL) -> DataFrame:
    """Dispatch per country, part, dealer and day, for parts billed in ``segment``
    (a semi join: each dispatch row at most once)."""
    n, m = window
    lines = dispatch_lines(dispatch, as_of, n, m)
    daily = lines.groupBy("Country", "Part_Id", "DealerCode", "LeoDate").agg(
        F.sum("qty").alias("qty"), F.sum("value").alias("value"))
    return daily.join(segment_parts(billing, segment, lines), "Part_Id", "left_semi")


def monthly_actuals(dispatch: DataFrame, billing: DataFrame, as_of, segment: str,
                    window: tuple[int, int] = BACKTEST_ACTUAL) -> DataFrame:
    """Dispatched quantity and value per part and month for parts of ``segment``.

    The two-level sum of the original (day/dealer, then month) equals one sum
    per (part, month), and the segment filter depends on the part only, so the
    sums come first (partial aggregation before the shuffle) and the semi join
    sees one row per part and month.
    """
    n, m = window
    lines = dispatch_lines(dispatch, as_of, n, m)
    monthly = lines.groupBy("Part_Id", F.trunc("LeoDate", "MM").alias("start_of_month")).agg(
        F.sum("qty").alias("qty"), F.sum("value").alias("value"))
    return monthly.join(segment_parts(billing, segment, lines), "Part_Id", "left_semi")


DEALER_PRICE_WINDOW = (5, 2)


def dealer_unit_price(dispatch: DataFrame, as_of, window: tuple[int, int] = DEALER_PRICE_WINDOW) -> DataFrame:
    """Unit price per dealer and part (dealer not projected): ``Part_Id, NDP``."""
    n, m = window
    return unit_price(dispatch, as_of, n, m, by=("DealerCode", "Part_Id"))
