from .rules import argmax_label, decide, map_values, pattern_map, set_map, suffix_map, tier
from .scalars import (
    business_days, cents_to_dollars, clamp, concat_skip_nulls, day_of_week0, exact_ratio, hours_between,
    margin_percent, mean, mean_over, month_diff, months_back, parse_month_first, row_hash, safe_decimal,
    safe_divide, safe_int, season_of, surrogate_key, year_month,
)
