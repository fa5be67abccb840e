"""Small hand-made inputs in the canonical layouts (tests only)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

AS_OF = "2000-12-15"

BILLING_SCHEMA = T.StructType([
    T.StructField("MaterialNumber", T.StringType()),
    T.StructField("DealerID", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("BillingDate", T.DateType()),
    T.StructField("BilledQuantity", T.DoubleType()),
    T.StructField("BilledValue", T.DecimalType(18, 2)),
    T.StructField("industry", T.StringType()),
    T.StructField("Type", T.StringType()),
])

MASTER_SCHEMA = T.StructType([
    T.StructField("2W_Part_Id", T.StringType()),
    T.StructField("3W_Part_Id", T.StringType()),
    T.StructField("Alternate_Part_Id", T.StringType()),
    T.StructField("Part_Description", T.StringType()),
])

CLASS_SCHEMA = T.StructType([
    T.StructField("Part_no", T.StringType()),
    T.StructField("value_contribution_pct", T.DoubleType()),
    T.StructField("qty_contribution_pct", T.DoubleType()),
    T.StructField("value_contribution_cumsum", T.DoubleType()),
    T.StructField("qty_contribution_cumsum", T.DoubleType()),
    T.StructField("value_contribution_pct_category", T.StringType()),
    T.StructField("qty_contribution_pct_category", T.StringType()),
    T.StructField("categorisation", T.StringType()),
    T.StructField("NDP", T.DoubleType()),
])

PLAN_SCHEMA = T.StructType([
    T.StructField("Month", T.StringType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Plan", T.DoubleType()),
])


def line(part, day, qty, value, dealer="D1", country="C1", segment="2W", kind="Parts"):
    return (part, dealer, country, dt.date.fromisoformat(day), float(qty), Decimal(str(value)), segment, kind)


def billing(spark, rows):
    return spark.createDataFrame(rows, BILLING_SCHEMA)


def master(spark, rows):
    return spark.createDataFrame(rows, MASTER_SCHEMA)


def class_table(spark, rows):
    """rows: (part, value class, movement class, NDP)."""
    full = [(p, 0.0, 0.0, 0.0, 0.0, a, f, "x", ndp) for p, a, f, ndp in rows]
    return spark.createDataFrame(full, CLASS_SCHEMA)


def plan(spark, rows):
    return spark.createDataFrame(rows, PLAN_SCHEMA)
