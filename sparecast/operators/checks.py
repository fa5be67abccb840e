"""Reconciliation figures for a run (what the original jobs eyeballed).

All figures are one-row aggregates placed side by side as scalar subqueries;
nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import with_scalars


def class_table_checks(class_table: DataFrame) -> DataFrame:
    """Shares should sum to 100; there should be one row per part."""
    return class_table.agg(
        F.round(F.sum("value_contribution_pct"), 6).alias("value_pct_sum"),
        F.round(F.sum("qty_contribution_pct"), 6).alias("qty_pct_sum"),
        F.count(F.lit(1)).alias("class_rows"),
        F.countDistinct("Part_no").alias("class_parts"),
    )


def forecast_checks(part_forecast: DataFrame) -> DataFrame:
    """Rows should be parts x months."""
    return part_forecast.agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.countDistinct("Forecast_month").alias("forecast_months"),
        F.countDistinct("Part_Id").alias("forecast_parts"),
    )


def demand_checks(monthly: DataFrame) -> DataFrame:
    """Parts with demand before the active filter and the latest month seen."""
    return monthly.agg(
        F.countDistinct("Part_Id").alias("demand_parts"),
        F.max("start_of_month").alias("latest_month"),
    )


def reconcile(class_table: DataFrame, part_forecast: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row of run figures; ``forecast_complete`` is rows == parts x months."""
    df = with_scalars(with_scalars(class_table_checks(class_table), forecast_checks(part_forecast)),
                      demand_checks(monthly))
    return df.withColumn(
        "forecast_complete",
        F.col("forecast_rows") == F.col("forecast_parts") * F.col("forecast_months"),
    )
