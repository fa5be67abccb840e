"""Unit price (NDP): ``round(sum(value) / sum(qty), 2)`` over dispatches.

The division runs on DECIMAL, so the half-up rounding to cents is exact; the
price is reported as DOUBLE.  A zero quantity gives NULL, not an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import safe_div
from ..functions.periods import in_month_window, month_window


def dispatch_lines(dispatch: DataFrame, as_of, n: int, m: int) -> DataFrame:
    """Dispatch lines in the whole-month window ``(n, m)`` with canonical names."""
    return dispatch.where(in_month_window("LeoDate", as_of, n, m)).select(
        F.col("MaterialNumber").alias("Part_Id"),
        F.col("DealerCode"),
        F.col("Country"),
        F.col("LeoDate").cast("date").alias("LeoDate"),
        F.col("DispatchQuantity").alias("qty"),
        F.col("DispatchValue").alias("value"),
    )


def unit_price(dispatch: DataFrame, as_of, n: int, m: int,
               by: Sequence[str] = ("Part_Id",), keep_keys: bool = False) -> DataFrame:
    """Unit price per ``by`` keys.

    ``by=("DealerCode", "Part_Id")`` prices each dealer separately; with
    ``keep_keys=False`` only ``Part_Id, NDP`` are returned (several rows per
    part at dealer grain).
    """
    lines = dispatch_lines(dispatch, as_of, n, m)
    agg = lines.groupBy(*by).agg(
        F.sum("qty").alias("_qty"),
        F.sum("value").alias("_value"),
    )
    price = F.round(safe_div(F.col("_value"), F.col("_qty").cast("decimal(20,0)")), 2).cast("double")
    cols = list(by) if keep_keys else ["Part_Id"]
    return agg.select(*cols, price.alias("NDP"))


def unit_prices_by_segment(dispatch: DataFrame, as_of, windows: dict) -> DataFrame:
    """``Part_Id, industry, NDP``: each segment's unit price over its own window
    (``{segment: (n, m)}``), all from one scan of the widest window.

    Each window becomes a conditional sum in one aggregation; a part without
    dispatches in a segment's window gets a NULL price there (as a missing row
    would after the left join of the class table).
    """
    bounds = {seg: month_window(as_of, n, m) for seg, (n, m) in windows.items()}
    lo, hi = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())
    lines = dispatch.where((F.col("LeoDate") >= F.lit(lo)) & (F.col("LeoDate") < F.lit(hi))).select(
        F.col("MaterialNumber").alias("Part_Id"),
        F.col("LeoDate").cast("date").alias("LeoDate"),
        F.col("DispatchQuantity").alias("qty"),
        F.col("DispatchValue").alias("value"),
    )
    aggs, prices = [], []
    for i, (seg, (start, end)) in enumerate(bounds.items()):
        inside = (F.col("LeoDate") >= F.lit(start)) & (F.col("LeoDate") < F.lit(end))
        aggs += [F.sum(F.when(inside, F.col("qty"))).alias(f"_q{i}"),
                 F.sum(F.when(inside, F.col("value"))).alias(f"_v{i}")]
        ndp = F.round(safe_div(F.col(f"_v{i}"), F.col(f"_q{i}").cast("decimal(20,0)")), 2).cast("double")
        prices.append(F.struct(F.lit(seg).alias("industry"), ndp.alias("NDP")))
    per_part = lines.groupBy("Part_Id").agg(*aggs)
    return per_part.select("Part_Id", F.explode(F.array(*prices)).alias("_p")).select(
        "Part_Id", "_p.industry", "_p.NDP")
