"""Column helpers and the fixed business values of the planning jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the business rules of the original jobs.
# ---------------------------------------------------------------------------

# Pareto cuts on the running share, in percent: [0, 80] first class,
# (80, 95] second class, everything else third class.
PARETO_FIRST_CUT = 80
PARETO_SECOND_CUT = 95

# Class letters: value classes (ABC) and movement classes (FMS).
VALUE_CLASSES = ("A", "B", "C")
MOVEMENT_CLASSES = ("F", "M", "S")

# Category of a (value class, movement class) pair; any other pair is "Stranger".
CATEGORY_OF_PAIR = {
    "AF": "Runner",
    "AM": "Runner",
    "BF": "Runner",
    "BM": "Repeater",
    "CF": "Repeater",
}
DEFAULT_CATEGORY = "Stranger"

# Forecast weight per class pair (12-month forecast); any other pair weighs 0.
FORECAST_WEIGHTS = {
    "AF": 4, "AM": 4, "BF": 2, "BM": 2, "CF": 1, "AS": 1, "BS": 1, "CM": 1, "CS": 1,
}
# Weight per class pair used by the one-month back-test.
BACKTEST_WEIGHTS = {
    "AF": 20, "AM": 20, "BF": 10, "BM": 5, "CF": 3, "AS": 2, "BS": 1, "CM": 1, "CS": 1,
}
# Share of the class weight and of the part's own demand in the forecast weight.
CLASS_WEIGHT_SHARE = 0.7
DEMAND_WEIGHT_SHARE = 0.3

# Coverage cut of the dealer/country split: keep members while the running
# share is at most 99.5 percent (stored as per-mille to stay exact).
COVERAGE_CUT_PER_MILLE = 995

# Values written into the publish layout.
FORECAST_TYPE = "Forecast"
UPLOAD_DEFAULT_CLASS = "A_F"

# Text that marks a part as excluded from forecasting (case-insensitive).
EXCLUDED_PART_TEXT = "BATTERY"

# ---------------------------------------------------------------------------


def with_scalars(df, one_row) -> "DataFrame":  # noqa: F821
    """Attach every column of a one-row aggregate ``one_row`` to each row of ``df``.

    Uses one scalar subquery (a struct of all columns): Spark evaluates it once
    and inlines the value, so no join and no exchange of ``df`` is needed.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumns({c: packed.getField(c) for c in one_row.columns})


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI-safe)."""
    return F.try_divide(col_(num), col_(den))


def lookup(c: str | Column, mapping: dict, default=None) -> Column:
    """``CASE c WHEN k1 THEN v1 ... ELSE default END`` over a small fixed mapping."""
    c = col_(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def class_code(pair: str | Column) -> Column:
    """``AF`` -> ``A_F`` for the nine class pairs; any other text passes through."""
    return F.regexp_replace(col_(pair), r"^([ABC])([FMS])$", "$1_$2")


def clamp_at_zero(c: str | Column) -> Column:
    """``max(0, x)`` where NULL becomes 0 (never NaN)."""
    return F.greatest(F.lit(0.0), col_(c).cast("double"))


def contains_ci(c: str | Column, text: str) -> Column:
    """Case-insensitive substring test; NULL text counts as "does not contain"."""
    pattern = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    return F.coalesce(col_(c).ilike(pattern), F.lit(False))
