"""Distributed running total over a whole table (descending, RANGE frame).

``sum(v) OVER (ORDER BY v DESC)`` without a partition clause plans an
``Exchange SinglePartition``: every row goes to one task.  This operator gives
the same answer with the work spread over buckets:

1. Cut points: approximate quantiles of ``v``, as many as there are shuffle
   partitions, evaluated once (never data rows) and held in one constant
   array, in which a row's bucket is found by bisection: the expression is the same for
   8 and for 2,000 buckets, and its cost grows with their logarithm.  A
   row's bucket is a pure function of its value, so ties never split between
   buckets and a retried task computes the same bucket.  The cut points of
   several columns come from one aggregate, observed during the job that
   checkpoints the input (no extra pass).
2. A value that is two quantiles or more at once is shared by many rows.  Such
   a heavy value is a bucket of its own, and so are the NULLs.
3. Bucket totals (at most two per cut point, plus two) -> exclusive prefix sums.
4. The total of a heavy value's rows is the prefix sum with its bucket: they
   need no order and are spread over all tasks by a salt.  All other rows get a
   window inside their bucket, plus the prefix sum.

Every column costs one shuffle of the rows; there is no join by value.  Exact
for BIGINT and DECIMAL inputs.  NULL values sort last: their running total is
the sum of all non-NULL values (the RANGE frame includes every row before the
NULL peer group).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10000


def _buckets(spark, buckets: int | None) -> int:
    return max(1, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut_point_stats(spark, value_cols: Sequence[str], buckets: int | None = None) -> list:
    """Aggregate columns whose values :func:`cuts_from_stats` turns into cut points.

    Evaluate them with ``df.agg`` or, for free, with ``materialize_observed(df, ...)``.
    """
    n = _buckets(spark, buckets)
    fractions = [i / n for i in range(1, n)]
    accuracy = max(DEFAULT_ACCURACY, 20 * n)
    return [F.percentile_approx(c, fractions or [0.5], accuracy).alias(f"q_{c}") for c in value_cols]


def cuts_from_stats(stats: dict, value_cols: Sequence[str]) -> dict[str, list[tuple]]:
    """Per column ``(cut point, heavy)`` in descending order from the aggregates of :func:`cut_point_stats`."""
    out = {}
    for c in value_cols:
        q = [v for v in stats.get(f"q_{c}") or [] if v is not None]
        out[c] = [(v, q.count(v) > 1) for v in sorted(set(q), reverse=True)]
    return out


def plan_buckets(df: DataFrame, value_cols: Sequence[str], buckets: int | None = None) -> dict[str, list[tuple]]:
    """Cut points per column (one small aggregate job, a few numbers back)."""
    row = df.agg(*cut_point_stats(df.sparkSession, value_cols, buckets)).first()
    return cuts_from_stats(row.asDict() if row else {}, value_cols)


def _constant_array(values: list) -> Column:
    """One constant array column of numbers (folded once, not one literal per value)."""
    first = values[0]
    if isinstance(first, Decimal):
        kind = f"decimal(38,{max(0, *(-v.as_tuple().exponent for v in values))})"
    else:
        kind = "double" if any(isinstance(v, float) for v in values) else "bigint"
    return F.split(F.lit(",".join(format(v, "f") if isinstance(v, Decimal) else repr(v) for v in values)), ",").cast(f"array<{kind}>")


def _bucket_of(v: Column, cuts: list[tuple]) -> Column:
    """Twice the number of cut points above ``v``, plus one if ``v`` is a heavy one;
    ascending buckets hold descending values, NULL ``v`` comes last."""
    if not cuts:
        return F.when(v.isNull(), F.lit(2)).otherwise(F.lit(0))
    points = _constant_array([c for c, _ in cuts])
    heavy = F.split(F.lit(",".join(str(h).lower() for _, h in cuts)), ",").cast("array<boolean>")

    def halve(span: Column, _step: Column) -> Column:
        # points before lo are > v, points from hi on are <= v
        lo, hi = span["lo"], span["hi"]
        mid = F.shiftright(lo + hi, 1)
        above = F.get(points, mid) > v
        return (F.when(lo >= hi, span).when(above, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
                .otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))))

    def bucket(span: Column) -> Column:
        lo = span["lo"]
        own = F.coalesce(F.get(heavy, lo) & (F.get(points, lo) == v), F.lit(False))
        return 2 * lo + own.cast("int")

    whole = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.when(v.isNull(), F.lit(2 * len(cuts) + 2)).otherwise(F.aggregate(steps, whole, halve, bucket))


def _with_running_total(df: DataFrame, value_col: str, out_col: str, cuts: list[tuple], by: Sequence[str]) -> DataFrame:
    v = F.col(value_col)
    alike = (F.col("_bucket") % 2 == 1) | v.isNull()
    rows = df.withColumn("_bucket", _bucket_of(v, cuts))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by, "_bucket").agg(F.sum(value_col).alias("_bucket_sum"))
        .select(*by, "_bucket", "_bucket_sum", F.sum("_bucket_sum").over(before).alias("_offset"))
    )
    salt = F.when(alike, F.pmod(F.xxhash64(*df.columns), F.lit(len(cuts) + 1))).otherwise(0)
    inside = Window.partitionBy(*by, "_bucket", "_salt").orderBy(v.desc_nulls_last())
    local = F.when(alike, F.col("_bucket_sum")).otherwise(F.col("_inside"))
    off = F.col("_offset")
    return (
        rows.withColumn("_salt", salt).withColumn("_inside", F.sum(value_col).over(inside))
        .join(F.broadcast(offsets), [*by, "_bucket"])
        .withColumn(out_col, F.when(off.isNull(), local).when(local.isNull(), off).otherwise(off + local))
        .select(*df.columns, out_col)
    )


def running_totals_desc(df: DataFrame, columns: dict[str, str], buckets: int | None = None,
                        cuts: dict[str, list[tuple]] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Add one running total per ``{value_col: out_col}``; same result as
    ``F.sum(v).over(Window.partitionBy(*by).orderBy(F.desc(v)))`` for each column.

    Groups (``by``, e.g. the segment; few) share the cut points; offsets are
    per group.  Without ``cuts`` the cut points are computed by one extra job
    over ``df``; pass them (see :func:`materialize_for_running_totals`) to avoid it.
    """
    if cuts is None:
        cuts = plan_buckets(df, list(columns), buckets)
    out = df
    for c, name in columns.items():
        out = _with_running_total(out, c, name, cuts[c], by)
    return out


def materialize_for_running_totals(df: DataFrame, value_cols: Sequence[str],
                                   buckets: int | None = None) -> tuple[DataFrame, dict]:
    """Checkpoint ``df`` and gather the cut points of ``value_cols`` in the same job."""
    from ..session import materialize_observed

    out, stats = materialize_observed(df, cut_point_stats(df.sparkSession, value_cols, buckets))
    return out, cuts_from_stats(stats, value_cols)
