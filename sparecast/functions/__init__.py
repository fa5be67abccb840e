"""Column expressions and calendar helpers."""

from .expressions import (  # noqa: F401
    BACKTEST_WEIGHTS,
    FORECAST_WEIGHTS,
    clamp_at_zero,
    class_code,
    contains_ci,
    lookup,
    safe_div,
)
from .periods import (  # noqa: F401
    first_of_month,
    horizon_months,
    in_month_window,
    month_label,
    month_label_of,
    month_start,
    month_window,
    run_date,
)
