"""Readers for the catalog tables the jobs consume.

A source is given as a catalog table name (``db.table``), a Parquet path, or an
existing DataFrame.  Readers only select the canonical columns; all filters are
applied later by the operators so Catalyst can push them into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical column names of the two fact sources.
BILLING_COLUMNS = (
    "MaterialNumber", "DealerID", "country", "BillingDate",
    "BilledQuantity", "BilledValue", "industry", "Type",
)
DISPATCH_COLUMNS = (
    "MaterialNumber", "Country", "DealerCode", "LeoDate",
    "DispatchQuantity", "DispatchValue",
)


def read_table(spark: SparkSession, source) -> DataFrame:
    """A DataFrame from a DataFrame, a catalog name, or a Parquet path."""
    if isinstance(source, DataFrame):
        return source
    text = str(source)
    if "/" in text or text.endswith(".parquet"):
        return spark.read.parquet(text)
    return spark.table(text)


def _canonical(df: DataFrame, columns: tuple[str, ...], names: dict[str, str] | None) -> DataFrame:
    """The canonical columns, each from the source column ``names`` gives for it (its own name otherwise)."""
    unknown = set(names or {}) - set(columns)
    if unknown:
        raise ValueError(f"not canonical columns: {', '.join(sorted(unknown))}; known are {', '.join(columns)}")
    return df.select(*[F.col(f"`{(names or {}).get(c, c)}`").alias(c) for c in columns])


def read_billing(spark: SparkSession, source, names: dict[str, str] | None = None) -> DataFrame:
    """Invoice lines: part, dealer, country, date, quantity, value, industry, type.

    ``names`` maps canonical columns to the source's own: ``{"BilledValue": "net_value"}``.
    """
    return _canonical(read_table(spark, source), BILLING_COLUMNS, names)


def read_dispatch(spark: SparkSession, source, names: dict[str, str] | None = None) -> DataFrame:
    """Dispatch lines: part, country, dealer, date, quantity, value (``names`` as for billing)."""
    return _canonical(read_table(spark, source), DISPATCH_COLUMNS, names)
