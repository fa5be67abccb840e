"""CSV inputs: parts master, monthly plan, manual forecast upload.

Columns are found by their header (in any order, further columns are ignored)
and read as text with the encoding the files are delivered in; a required
column that is missing is an error.  Only the empty string is NULL, so that a
country code like ``NA`` stays text.  Numbers are parsed explicitly
(``1,234.5`` too); rows that cannot be used are reported, never silently NULL.

Quoted fields may hold commas, doubled quotes and line breaks.  A line with
fewer fields than the header has NULL for the others; one with more fields is broken
(its fields cannot be told apart) and goes to the rejects, with the first
surplus field in ``BAD_LINE`` (an empty one, as of a comma at the end, carries nothing and is ignored).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS_MASTER_COLUMNS = ("2W_Part_Id", "3W_Part_Id", "Alternate_Part_Id", "Part_Description")
PLAN_COLUMNS = ("Month", "Type", "Plan")
UPLOAD_COLUMNS = ("order_date", "dealer_id", "country", "part_id", "order_qty", "type", "Material Description",
                  "industry", "ABC_FMS", "run_date")
UPLOAD_OPTIONAL = ("ABC_FMS",)

#: The first field beyond the header's, in lines that have one.
BAD_LINE = "_bad_line"


@dataclass(frozen=True)
class Checked:
    """The usable rows of a file, and the others as text with a ``reject`` reason."""

    rows: DataFrame
    rejects: DataFrame


def read_by_header(spark: SparkSession, path: str, columns: Sequence[str], encoding: str,
                   optional: Sequence[str] = ()) -> DataFrame:
    """The named columns as text (NULL for an optional one that is not there), and ``BAD_LINE``."""

    def reader():
        return (spark.read.option("header", True).option("encoding", encoding).option("multiLine", True)
                .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))

    header = reader().option("inferSchema", False).csv(path).columns
    found: dict[str, int] = {}
    for k, c in enumerate(header):
        found.setdefault(c.strip().lstrip("\ufeff").removeprefix("ï»¿").strip(), k)
    missing = [c for c in columns if c not in found and c not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(found) or 'none'}")
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(header))] + [T.StructField(BAD_LINE, T.StringType())])
    raw = reader().schema(schema).option("nullValue", "").csv(path)
    return raw.select(*[
        (F.nullif(F.col(f"c{found[c]}"), F.lit("")) if c in found else F.lit(None)).cast("string").alias(c) for c in columns], BAD_LINE)


def number(column: str) -> Column:
    """The number in a text column, thousands separators allowed; NULL where there is none."""
    return F.expr(f"try_cast(replace(trim(`{column}`), ',', '') AS DOUBLE)")


def check_parts_master(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> Checked:
    """Active parts master: one id column per segment, a description, all text.  Rejected: broken lines."""
    read = read_by_header(spark, path, PARTS_MASTER_COLUMNS, encoding)
    good = read.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    bad = read.where(F.col(BAD_LINE).isNotNull()).withColumn("reject", F.lit("line")).drop(BAD_LINE)
    return Checked(good, bad)


def read_parts_master(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", allow_rejects: bool = False) -> DataFrame:
    """The usable rows of :func:`check_parts_master`; broken lines are an error unless allowed."""
    return _usable(check_parts_master(spark, path, encoding), path, "master rows", "check_parts_master", allow_rejects)


def _usable(read: Checked, path: str, what: str, check: str, allow_rejects: bool) -> DataFrame:
    if not allow_rejects and (bad := read.rejects.count()):
        raise ValueError(f"{path}: {bad} {what} cannot be read (see {check}(...).rejects)")
    return read.rows


def check_plan(spark: SparkSession, path: str, encoding: str = "UTF-8") -> Checked:
    """Monthly money plan: ``Month`` (``Nov-24``), ``Type`` (segment), ``Plan``.

    Rejected: a month that is no ``MMM-yy`` label, no segment, a plan that is no number, a broken line.
    """
    text = read_by_header(spark, path, PLAN_COLUMNS, encoding)
    month = F.trim("Month")
    readable = F.try_to_date(F.concat(F.lit("01-"), month), "dd-MMM-yy").isNotNull()
    reasons = F.concat_ws(",", F.when(F.col(BAD_LINE).isNotNull(), "line"), F.when(~F.coalesce(readable, F.lit(False)), "Month"),
                          F.when(F.coalesce(F.trim("Type"), F.lit("")) == "", "Type"), F.when(number("Plan").isNull(), "Plan"))
    read = text.withColumn("reject", F.nullif(reasons, F.lit(""))).drop(BAD_LINE)
    good = read.where(F.col("reject").isNull()).select(month.alias("Month"), F.trim("Type").alias("Type"), number("Plan").alias("Plan"))
    return Checked(good, read.where(F.col("reject").isNotNull()))


def read_plan(spark: SparkSession, path: str, encoding: str = "UTF-8", allow_rejects: bool = False) -> DataFrame:
    """The usable rows of :func:`check_plan`; unusable ones are an error unless allowed.

    A month without a plan is forecast without a money target, so a plan row
    that cannot be read must not pass unseen.
    """
    return _usable(check_plan(spark, path, encoding), path, "plan rows", "check_plan", allow_rejects)


def read_upload(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Manual forecast upload, all text (a column name with a space, ``ABC_FMS`` may be missing).

    Dates and numbers are parsed, and unusable rows and broken lines (``BAD_LINE``) counted, where the
    upload is applied.
    """
    return read_by_header(spark, path, UPLOAD_COLUMNS, encoding, UPLOAD_OPTIONAL)
