"""Column and aggregate expressions (built-in Spark functions only)."""

from .aggregates import avg_rounded, count_where, pct_where, ratio_pct, safe_corr
from .columns import (all_of, bucketize, clamp_min, clean_header, clean_text, date_key,
                      days_between, default_if_null, fallback, is_blank, late_flag, lower_text,
                      map_lookup, null_if_before, null_nonpositive, pad_code, round_half_up,
                      to_decimal, to_double, to_int, to_timestamp, upper_text)

__all__ = [
    "all_of", "avg_rounded", "bucketize", "clamp_min", "clean_header",
    "clean_text", "count_where", "date_key", "days_between", "default_if_null", "fallback",
    "is_blank", "late_flag", "lower_text", "map_lookup", "null_if_before", "null_nonpositive",
    "pad_code", "pct_where", "ratio_pct", "round_half_up", "safe_corr",
    "to_decimal", "to_double", "to_int", "to_timestamp", "upper_text",
]
