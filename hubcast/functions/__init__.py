from .dates import default_target_end_date, saturday_of_week, week_end, weeks_since_epoch
from .nulls import complete, strict, strict_avg, strict_median
from .numeric import log_ratio, ordered_mean, ordered_sum, round_decimal, round_half_even, safe_div

__all__ = [
    "week_end", "saturday_of_week", "default_target_end_date", "weeks_since_epoch", "complete", "strict",
    "strict_avg", "strict_median", "round_half_even", "round_decimal", "ordered_sum", "ordered_mean",
    "safe_div", "log_ratio",
]
