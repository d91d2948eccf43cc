from salesloom.functions.columns import (
    absolute_percentage_error,
    blended_error,
    clean_manager,
    month_start,
    non_negative,
    ratio,
    rounded,
    season_number,
    whole,
)
from salesloom.functions.quantiles import exact_quantiles, padded_sorted

__all__ = [
    "absolute_percentage_error",
    "blended_error",
    "clean_manager",
    "exact_quantiles",
    "month_start",
    "non_negative",
    "padded_sorted",
    "ratio",
    "rounded",
    "season_number",
    "whole",
]
