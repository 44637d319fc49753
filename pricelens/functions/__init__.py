from pricelens.functions.dates import as_of_column, future_weeks, week_start
from pricelens.functions.numeric import (
    direction,
    exact_mean,
    exact_sum,
    floor_zero,
    js_round,
    minmax_position,
    nullif_zero,
    pct_change,
    round_exact,
)

__all__ = [
    "as_of_column", "future_weeks", "week_start", "direction", "exact_mean",
    "exact_sum", "floor_zero", "js_round", "minmax_position", "nullif_zero",
    "pct_change", "round_exact",
]
