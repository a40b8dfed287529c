"""Column functions: classification, rounding, shares, calendar."""

from .calendar import (TIME_FEATURES, date_attribute_columns, is_peak_hour, is_weekday,
                       season, time_feature_columns, with_time_features)
from .scalar import (classify, classify_by, coalesce_zero, hour_ending_ts, pct,
                     round_half_up, row_sum, safe_div, to_number)

__all__ = [
    "TIME_FEATURES", "classify", "classify_by", "coalesce_zero", "date_attribute_columns",
    "hour_ending_ts", "is_peak_hour", "is_weekday", "pct", "round_half_up", "row_sum",
    "safe_div", "season", "time_feature_columns", "to_number", "with_time_features",
]
