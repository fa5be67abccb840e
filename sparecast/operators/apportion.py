"""Split the part forecast over dealers and countries by recent share.

Ratios (per part, over six whole months of deduplicated demand):

* each (dealer, country) member's share of the part's quantity;
* members in descending share order with a running share (ties share one
  value); members are kept while the running share is at most 99.5 percent,
  so the smallest member (or tied group) is always dropped, and a part with a
  single member, or whose members all tie, gets no ratio at all;
* survivors re-normalised to sum to 1.

All windows are partitioned by part, over rows already aggregated to
(part, dealer, country): a part brings at most one row per dealer and country
into its task however many invoice lines it has.  The three windows share one
exchange on ``Part_Id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import COVERAGE_CUT_PER_MILLE
from .demand import segment_demand

RATIO_WINDOW = (7, 1)


def _group(segment) -> list[str]:
    """Grouping keys of a part: the part, and the segment when several are processed."""
    return ["Part_Id"] if isinstance(segment, str) else ["industry", "Part_Id"]


def dealer_shares(billing: DataFrame, as_of, segment: str | Sequence[str],
                  window: tuple[int, int] = RATIO_WINDOW, dedup: bool = True) -> DataFrame:
    """``Part_Id, DealerID, country, qty, total_qty, cumulative_qty,
    contribution_percentage, rank`` for parts with a positive total.

    ``segment`` may be several segments (one pass): rows then carry ``industry``
    and every window is per (industry, part).
    """
    n, m = window
    group = _group(segment)
    dd = segment_demand(billing, as_of, n, m, segment, by=(*group, "DealerID", "country"),
                        dedup=dedup, require_dealer_country=True)
    by_part = Window.partitionBy(*group)
    by_share = by_part.orderBy(F.col("qty").desc())
    ranked = by_part.orderBy(F.col("qty").desc(), F.col("DealerID"), F.col("country"))
    return (
        dd.withColumn("total_qty", F.sum("qty").over(by_part))
        .where(F.col("total_qty") > 0)
        .withColumn("cumulative_qty", F.sum("qty").over(by_share))
        .withColumn("contribution_percentage",
                    F.col("qty").cast("double") / F.col("total_qty").cast("double") * F.lit(100.0))
        .withColumn("rank", F.row_number().over(ranked))
    )


def coverage_cut(shares: DataFrame, per_mille: int = COVERAGE_CUT_PER_MILLE,
                 keep_crossing: bool = False) -> DataFrame:
    """Members whose running share is at most ``per_mille`` / 10 percent (exact).

    With ``keep_crossing`` the member (or tied group) whose running share first
    passes the cut is kept too, so no part loses all its members.  Its "share
    before" is the running total minus its tie group; the tie count is a window
    over (part, qty), which the part partitioning already serves.
    """
    limit = F.col("total_qty") * F.lit(per_mille)
    kept = F.col("cumulative_qty") * F.lit(1000) <= limit
    if not keep_crossing:
        return shares.where(kept)
    group = ["industry", "Part_Id"] if "industry" in shares.columns else ["Part_Id"]
    tied = F.count(F.lit(1)).over(Window.partitionBy(*group, "qty"))
    before = F.col("cumulative_qty") - F.col("qty") * F.col("_tied")
    return shares.withColumn("_tied", tied).where(kept | (before * F.lit(1000) < limit)).drop("_tied")


def dealer_ratios(billing: DataFrame, as_of, segment: str | Sequence[str],
                  window: tuple[int, int] = RATIO_WINDOW, per_mille: int = COVERAGE_CUT_PER_MILLE,
                  dedup: bool = True, keep_crossing: bool = False) -> DataFrame:
    """``Part_Id, contribution_ratio, DealerID, country`` (plus ``industry`` for
    several segments); ratios of a part sum to 1."""
    group = _group(segment)
    kept = coverage_cut(dealer_shares(billing, as_of, segment, window, dedup), per_mille, keep_crossing)
    kept_total = F.sum("qty").over(Window.partitionBy(*group))
    return kept.select(
        *group[:-1],
        "Part_Id",
        (F.col("qty").cast("double") / kept_total.cast("double")).alias("contribution_ratio"),
        "DealerID",
        "country",
    )


def apportion(part_forecast: DataFrame, ratios: DataFrame) -> DataFrame:
    """Dealer/country forecast: ``Forecast_Qty = round(Rounded_Qty * ratio, 0)``.

    Output: ``Forecast_month, DealerID, country, industry, ABC_FMS, Part_Id,
    Forecast_Qty, Rounded_Qty``; rows without a country are dropped.  Each
    dealer is rounded on its own, so the dealer quantities of a part need not
    add up to the part quantity.
    """
    keys = ["industry", "Part_Id"] if "industry" in ratios.columns else ["Part_Id"]
    return (
        part_forecast.join(ratios, keys)
        .where(F.col("country").isNotNull())
        .select(
            F.col("Forecast_month").cast("date").alias("Forecast_month"),
            "DealerID", "country", "industry", "ABC_FMS", "Part_Id",
            F.round(F.col("Rounded_Qty") * F.col("contribution_ratio"), 0).alias("Forecast_Qty"),
            "Rounded_Qty",
        )
    )
