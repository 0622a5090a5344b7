from delayscope.functions.casting import (
    clean_text,
    first_filled,
    number,
    number_or_zero,
    whole,
    whole_or_zero,
)
from delayscope.functions.clock import bad_minutes, hour_of, hour_start, month_start
from delayscope.functions.measures import (
    all_null,
    any_null,
    cause_total,
    close_to,
    delay_band,
    percent,
    share_percent,
)
from delayscope.functions.rounding import binary_round, mean_std_text, number_text, thousands

__all__ = [
    "all_null", "any_null", "bad_minutes", "binary_round", "cause_total", "clean_text",
    "close_to", "delay_band", "first_filled", "hour_of", "hour_start", "mean_std_text",
    "month_start", "number", "number_or_zero", "number_text", "percent", "share_percent",
    "thousands", "whole", "whole_or_zero",
]
