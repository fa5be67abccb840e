"""ABC (value) / FMS (movement) classification of parts.

For each part: its share of the segment's total value and quantity, the
running share in descending order (ties share one value), a class letter per
running share, the category of the class pair, and the unit price.

Comparisons use exact running totals, not rounded percentages:
``cum * 100 <= 80 * total`` on DECIMAL/BIGINT, so a class never depends on the
summation order.  Percentages are reported as doubles.  Grand totals are
assumed positive (net returns larger than sales leave shares undefined).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    CATEGORY_OF_PAIR,
    DEFAULT_CATEGORY,
    MOVEMENT_CLASSES,
    PARETO_FIRST_CUT,
    PARETO_SECOND_CUT,
    VALUE_CLASSES,
    lookup,
    safe_div,
    with_scalars,
)
from .demand import segment_demand
from .pricing import unit_price, unit_prices_by_segment
from .running import materialize_for_running_totals, running_totals_desc

CLASS_TABLE_COLUMNS = (
    "Part_no", "value_contribution_pct", "qty_contribution_pct",
    "value_contribution_cumsum", "qty_contribution_cumsum",
    "value_contribution_pct_category", "qty_contribution_pct_category",
    "categorisation", "NDP",
)


def pct(part: str | Column, total: str | Column) -> Column:
    """``part / total * 100`` as DOUBLE (NULL when the total is 0)."""
    p = F.col(part) if isinstance(part, str) else part
    t = F.col(total) if isinstance(total, str) else total
    return safe_div(p.cast("double"), t.cast("double")) * F.lit(100.0)


def pareto_letter(cum: str | Column, total: str | Column, letters: tuple[str, str, str],
                  first_cut: int = PARETO_FIRST_CUT, second_cut: int = PARETO_SECOND_CUT) -> Column:
    """First letter while ``0 <= cum share <= first_cut``; second while
    ``<= second_cut``; otherwise (including NULL) the third."""
    c = F.col(cum) if isinstance(cum, str) else cum
    t = F.col(total) if isinstance(total, str) else total
    hundred = F.lit(100)
    return (
        F.when((c >= 0) & (c * hundred <= t * F.lit(first_cut)), F.lit(letters[0]))
        .when((c * hundred > t * F.lit(first_cut)) & (c * hundred <= t * F.lit(second_cut)), F.lit(letters[1]))
        .otherwise(F.lit(letters[2]))
    )


def categorise(value_class: str | Column, movement_class: str | Column) -> Column:
    """Runner / Repeater / Stranger from the class pair."""
    vc = F.col(value_class) if isinstance(value_class, str) else value_class
    mc = F.col(movement_class) if isinstance(movement_class, str) else movement_class
    return lookup(F.concat(vc, mc), CATEGORY_OF_PAIR, DEFAULT_CATEGORY)


def grand_totals(demand: DataFrame) -> DataFrame:
    """One row: ``_total_value, _total_qty``."""
    return demand.agg(F.sum("value").alias("_total_value"), F.sum("qty").alias("_total_qty"))


def with_totals(demand: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Attach the grand totals of ``value`` and ``qty`` (a scalar subquery)."""
    return with_scalars(demand, grand_totals(demand) if totals is None else totals)


def share_of_total(demand: DataFrame) -> DataFrame:
    """``Part_no, value_contribution_pct, qty_contribution_pct`` per part."""
    return with_totals(demand).select(
        F.col("Part_Id").alias("Part_no"),
        pct("value", "_total_value").alias("value_contribution_pct"),
        pct("qty", "_total_qty").alias("qty_contribution_pct"),
    )


def pareto_classes(demand: DataFrame, buckets: int | None = None, cuts: dict | None = None,
                   by: tuple[str, ...] = ()) -> DataFrame:
    """Class columns for a part-level demand frame (``[*by,] Part_Id, qty, value``).

    Output: the class-table columns without ``NDP`` (plus ``by``).  With ``by``
    (the segment) shares, running totals and classes are computed per group;
    the per-group totals are one row per group, joined by broadcast.
    """
    df = running_totals_desc(demand, {"value": "_cum_value", "qty": "_cum_qty"}, buckets, cuts, by)
    if by:
        totals = demand.groupBy(*by).agg(F.sum("value").alias("_total_value"), F.sum("qty").alias("_total_qty"))
        df = df.join(F.broadcast(totals), list(by))
    else:
        df = with_totals(df, grand_totals(demand))
    a, b, c = VALUE_CLASSES
    f, m, s = MOVEMENT_CLASSES
    df = df.select(
        *by,
        F.col("Part_Id").alias("Part_no"),
        pct("value", "_total_value").alias("value_contribution_pct"),
        pct("qty", "_total_qty").alias("qty_contribution_pct"),
        pct("_cum_value", "_total_value").alias("value_contribution_cumsum"),
        pct("_cum_qty", "_total_qty").alias("qty_contribution_cumsum"),
        pareto_letter("_cum_value", "_total_value", (a, b, c)).alias("value_contribution_pct_category"),
        pareto_letter("_cum_qty", "_total_qty", (f, m, s)).alias("qty_contribution_pct_category"),
    )
    return df.withColumn(
        "categorisation",
        categorise("value_contribution_pct_category", "qty_contribution_pct_category"),
    )


# Whole-month windows of the classification: demand over 12 months ending last
# month; unit price over 5 (2W) or 3 (3W) months ending two months back.
CLASS_WINDOW = (13, 1)
PRICE_WINDOW = {"2W": (7, 2), "3W": (5, 2)}


def classify_parts(billing: DataFrame, dispatch: DataFrame, as_of, segment: str,
                   demand_window: tuple[int, int] = CLASS_WINDOW,
                   price_window: tuple[int, int] | None = None,
                   dedup: bool = True, buckets: int | None = None) -> DataFrame:
    """The class table of a segment (one row per billed part).

    The part-level demand is written to the checkpoint folder once: the totals,
    the two running totals and their cut points all read it, and none of them
    should rescan the invoice lines.
    """
    n, m = demand_window
    demand, cuts = materialize_for_running_totals(
        segment_demand(billing, as_of, n, m, segment, dedup=dedup), ["value", "qty"], buckets)
    classes = pareto_classes(demand, buckets, cuts)
    pn, pm = price_window or PRICE_WINDOW[segment]
    prices = unit_price(dispatch, as_of, pn, pm).withColumnRenamed("Part_Id", "Part_no")
    return classes.join(prices, "Part_no", "left").select(*CLASS_TABLE_COLUMNS)


def category_counts(class_table: DataFrame) -> DataFrame:
    """Number of parts per category: ``categorisation, count``."""
    return class_table.groupBy("categorisation").agg(F.count(F.lit(1)).alias("count"))


def classify_segments(billing: DataFrame, dispatch: DataFrame, as_of, segments=("2W", "3W"),
                      demand_window: tuple[int, int] = CLASS_WINDOW, price_windows: dict | None = None,
                      dedup: bool = True, buckets: int | None = None) -> DataFrame:
    """The class tables of several segments from one pass over the invoice lines
    and one over the dispatches; the class-table columns plus ``industry``.

    Equal to :func:`classify_parts` per segment: shares, running totals and
    classes are per segment (``industry`` is a grouping key everywhere), and
    each segment's price uses its own window.
    """
    n, m = demand_window
    segments = tuple(segments)
    demand, cuts = materialize_for_running_totals(
        segment_demand(billing, as_of, n, m, segments, by=("industry", "Part_Id"), dedup=dedup),
        ["value", "qty"], buckets)
    classes = pareto_classes(demand, buckets, cuts, by=("industry",))
    windows = {s: (price_windows or PRICE_WINDOW)[s] for s in segments}
    prices = unit_prices_by_segment(dispatch, as_of, windows).withColumnRenamed("Part_Id", "Part_no")
    return classes.join(prices, ["industry", "Part_no"], "left").select(*CLASS_TABLE_COLUMNS, "industry")
