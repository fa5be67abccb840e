"""Base demand per part and the plan-driven 12-month forecast.

Base demand (per active, non-excluded part with a class):
``qty = ceil(total quantity / number of months with demand)``, the unit price
and class pair from the class table, ``OrderValue = qty * NDP`` and the class
weight of the pair.

Forecast, per part and month of the horizon::

    W    = weight * 0.7 + qty / SUM(Total_qty) * 0.3
    adj  = (Plan - SUM(OrderValue)) / Plan * W      if Plan <> 0 else 0
    Updated_Qty = qty * (1 + adj)
    Rounded_Qty = ceil(Updated_Qty);  value = Rounded_Qty * NDP
    all three clamped at 0 (a missing price gives value 0)

The plan of a month is the sum of the plan rows with that ``MMM-yy`` label and
segment (0 when there is none).  The horizon is generated per part with
``explode(sequence(...))``; the plan side is at most ``horizon`` rows (broadcast
with a proven size bound) and the two totals are one scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    CLASS_WEIGHT_SHARE,
    DEMAND_WEIGHT_SHARE,
    EXCLUDED_PART_TEXT,
    FORECAST_WEIGHTS,
    clamp_at_zero,
    contains_ci,
    lookup,
    with_scalars,
)
from ..functions.periods import horizon_months, month_label, month_label_of, month_window
from ..session import materialize
from .demand import active_month_demand

# Base demand windows: 9 (2W) or 8 (3W) whole months ending last month.
BASE_WINDOW = {"2W": (10, 1), "3W": (9, 1)}


def segment_id_column(segment: str) -> str:
    return f"{segment}_Part_Id"


def active_parts(master: DataFrame, segment: str, exclude_text: str | None = EXCLUDED_PART_TEXT,
                 with_description: bool = False) -> DataFrame:
    """Parts of ``segment`` in the master (id not NULL), minus those whose
    description contains ``exclude_text`` (case-insensitive; NULL text stays).

    Rows are not de-duplicated: a part listed twice is returned twice.
    """
    pid = F.col(f"`{segment_id_column(segment)}`")
    df = master.where(pid.isNotNull())
    if exclude_text:
        df = df.where(~contains_ci("Part_Description", exclude_text))
    cols = [pid.alias("Part_Id")]
    if with_description:
        cols.append(F.col("Part_Description"))
    return df.select(*cols)


def master_multiplicity(master: DataFrame, segment: str,
                        exclude_text: str | None = EXCLUDED_PART_TEXT,
                        dedup_master: bool = False) -> DataFrame:
    """``Part_Id, _k``: how often each active part is listed (one row per part;
    ``_k = 1`` with ``dedup_master``)."""
    count = F.lit(1).cast("bigint") if dedup_master else F.count(F.lit(1))
    return active_parts(master, segment, exclude_text).groupBy("Part_Id").agg(count.alias("_k"))


def avg_active_month(per_part: DataFrame, master: DataFrame, segment: str,
                     exclude_text: str | None = EXCLUDED_PART_TEXT,
                     dedup_master: bool = False) -> DataFrame:
    """``Part_Id, Total_qty, Months_Count, qty`` for active parts, from :func:`active_month_demand`.

    ``qty = ceil(Total_qty / Months_Count)``; the divisor counts months with a
    row for the part, not the window length.  A part listed ``k`` times in the
    master has its quantity counted ``k`` times (as a plain inner join would),
    unless ``dedup_master``.
    """
    return _averages(per_part, master_multiplicity(master, segment, exclude_text, dedup_master), ["Part_Id"])


def _averages(per_part: DataFrame, multiplicity: DataFrame, keys: list[str]) -> DataFrame:
    total = (F.col("_t") * F.col("_k")).cast("bigint")
    return per_part.join(multiplicity, keys).select(
        *keys, total.alias("Total_qty"), "Months_Count",
        F.ceil(total / F.col("Months_Count")).cast("double").alias("qty"))


def class_pairs(class_table: DataFrame, keys: tuple[str, ...] = ("Part_Id",)) -> DataFrame:
    """Distinct ``*keys, ABC_class, Fsn_class, NDP`` rows of a class table.

    Dealt by the keys once: both the DISTINCT and the join that follows use it.
    """
    rows = class_table.withColumnRenamed("Part_no", "Part_Id").select(
        *keys,
        F.col("value_contribution_pct_category").alias("ABC_class"),
        F.col("qty_contribution_pct_category").alias("Fsn_class"),
        F.col("NDP"),
    )
    return rows.repartition(*keys).distinct()


def _with_classes(avg: DataFrame, pairs: DataFrame, keys: list[str], weights: dict | None) -> DataFrame:
    pair = F.concat(F.col("ABC_class"), F.col("Fsn_class"))
    return avg.join(pairs, keys).withColumns({
        "OrderValue": F.col("qty") * F.col("NDP"),
        "ABC_FMS": pair,
        "ABC_FMS_Ratio": lookup(pair, weights or FORECAST_WEIGHTS, 0),
    })


def base_demand(billing: DataFrame, master: DataFrame, class_table: DataFrame, as_of,
                segment: str, window: tuple[int, int] | None = None,
                weights: dict | None = None, exclude_text: str | None = EXCLUDED_PART_TEXT,
                dedup: bool = True, dedup_master: bool = False) -> DataFrame:
    """Base demand rows: ``Part_Id, Total_qty, Months_Count, qty, ABC_class,
    Fsn_class, NDP, OrderValue, ABC_FMS, ABC_FMS_Ratio``."""
    n, m = window or BASE_WINDOW[segment]
    per_part = active_month_demand(billing, as_of, n, m, segment, dedup=dedup)
    avg = avg_active_month(per_part, master, segment, exclude_text, dedup_master)
    return _with_classes(avg, class_pairs(class_table), ["Part_Id"], weights)


def base_demand_segments(billing: DataFrame, master: DataFrame, class_table: DataFrame, as_of,
                         segments=("2W", "3W"), windows: dict | None = None,
                         weights: dict | None = None, exclude_text: str | None = EXCLUDED_PART_TEXT,
                         dedup: bool = True, dedup_master: bool = False) -> DataFrame:
    """:func:`base_demand` of several segments from one scan of the invoice lines.

    The widest window is read once; each segment keeps only its own months (a
    per-segment date condition), and ``industry`` is a key throughout.
    ``class_table`` holds all segments (with ``industry``).  Output: the base
    demand columns plus ``industry``.
    """
    segments = tuple(segments)
    wins = {s: (windows or BASE_WINDOW)[s] for s in segments}
    n, m = max(w[0] for w in wins.values()), min(w[1] for w in wins.values())
    keep = None
    for s, (sn, sm) in wins.items():
        start, end = month_window(as_of, sn, sm)
        cond = (F.col("industry") == F.lit(s)) & (F.col("LeoDate") >= F.lit(start)) & (F.col("LeoDate") < F.lit(end))
        keep = cond if keep is None else keep | cond
    keys = ["industry", "Part_Id"]
    per_part = active_month_demand(billing, as_of, n, m, segments, by=keys, dedup=dedup, line_filter=keep)
    mult = None
    for s in segments:
        one = master_multiplicity(master, s, exclude_text, dedup_master).withColumn("industry", F.lit(s))
        mult = one if mult is None else mult.unionByName(one)
    return _with_classes(_averages(per_part, mult, keys), class_pairs(class_table, tuple(keys)), keys, weights)


def month_plan(plan: DataFrame, segment, months) -> DataFrame:
    """``_label, [_plan_industry,] Plan``: summed plan per horizon month and
    segment (at most ``len(months)`` rows per segment)."""
    labels = [month_label_of(d) for d in months]
    if isinstance(segment, str):
        return (
            plan.where((F.col("Type") == F.lit(segment)) & F.col("Month").isin(labels))
            .groupBy(F.col("Month").alias("_label"))
            .agg(F.sum("Plan").alias("Plan"))
        )
    return (
        plan.where(F.col("Type").isin(*segment) & F.col("Month").isin(labels))
        .groupBy(F.col("Month").alias("_label"), F.col("Type").alias("_plan_industry"))
        .agg(F.sum("Plan").alias("Plan"))
    )


def forecast_frame(base: DataFrame, plan: DataFrame, as_of, segment, horizon: int = 12,
                   first_offset: int = 1) -> DataFrame:
    """Every base part for every horizon month with all formula columns.

    The formula is one projection (no chain of ``withColumn``); shared
    sub-expressions are evaluated once by whole-stage codegen.  ``base`` (one
    row per part) is read twice, by the totals and by the horizon, so it is
    checkpointed once instead of recomputing the class table and demand for
    each read.
    """
    months = horizon_months(as_of, horizon, first_offset)
    multi = not isinstance(segment, str)
    base = materialize(base)
    keys = ["industry"] if multi else []
    totals = base.groupBy(*keys).agg(
        F.sum("Total_qty").alias("_sum_total_qty"),
        F.sum(F.col("qty").cast("decimal(20,0)") * F.col("NDP").cast("decimal(18,2)"))
        .cast("double").alias("_sum_order_value"),
    )
    expanded = base.withColumn(
        "Forecast_month",
        F.explode(F.sequence(F.lit(months[0]), F.lit(months[-1]), F.expr("INTERVAL 1 MONTH"))),
    )
    on_plan = month_label("Forecast_month") == F.col("_label")
    if multi:
        # Several segments: totals per segment (one row each) and plan keyed by segment.
        on_plan = on_plan & (F.col("industry") == F.col("_plan_industry"))
        df = (expanded.join(F.broadcast(month_plan(plan, segment, months)), on_plan, "left")
              .join(F.broadcast(totals), keys))
    else:
        df = with_scalars(expanded.join(F.broadcast(month_plan(plan, segment, months)), on_plan, "left"),
                          totals)
    plan_value = F.coalesce(F.col("Plan"), F.lit(0.0))
    weight = (F.col("ABC_FMS_Ratio") * F.lit(CLASS_WEIGHT_SHARE)
              + F.col("qty") / F.col("_sum_total_qty") * F.lit(DEMAND_WEIGHT_SHARE))
    adj = F.when(
        plan_value != F.lit(0.0),
        (plan_value - F.col("_sum_order_value")) / plan_value * weight,
    ).otherwise(F.lit(0.0))
    updated = F.col("qty") * (F.lit(1.0) + adj)
    rounded = F.ceil(updated).cast("double")
    value = rounded.cast("decimal(20,0)") * F.col("NDP").cast("decimal(18,2)")
    keep = list(base.columns)
    return df.select(
        *keep,
        "Forecast_month",
        plan_value.alias("Plan"),
        weight.alias("Weighted_Ratio"),
        adj.alias("plan_and_order_adjusted"),
        rounded.alias("Rounded_raw"),
        clamp_at_zero(updated).alias("Updated_Qty"),
        clamp_at_zero(rounded).alias("Rounded_Qty"),
        clamp_at_zero(value).alias("forecast_value"),
        *([] if multi else [F.lit(segment).alias("industry")]),
    )


PART_FORECAST_COLUMNS = ("Part_Id", "Forecast_month", "Rounded_Qty", "ABC_FMS", "industry")


def plan_forecast(base: DataFrame, plan: DataFrame, as_of, segment, horizon: int = 12,
                  first_offset: int = 1) -> DataFrame:
    """Part forecast rows: ``Part_Id, Forecast_month, Rounded_Qty, ABC_FMS, industry``."""
    return forecast_frame(base, plan, as_of, segment, horizon, first_offset).select(*PART_FORECAST_COLUMNS)


def forecast_summary(frame: DataFrame) -> DataFrame:
    """Per forecast month: total quantity, total value (and as report text
    ``1,234,567.89``), parts."""
    return frame.groupBy("Forecast_month").agg(
        F.sum("Rounded_Qty").alias("total_qty"),
        F.sum(F.greatest(F.lit(0), F.col("Rounded_raw").cast("decimal(20,0)")
                         * F.col("NDP").cast("decimal(18,2)"))).cast("double").alias("total_value"),
        F.count(F.lit(1)).alias("parts"),
    ).withColumn("total_value_text", F.format_number("total_value", 2))
