"""Table-agnostic DataFrame operators."""

from .dedup import dedup, latest_per_key
from .integrity import (IntegrityError, check_orphans, check_unique, enforce, integrity_report,
                        row_conservation)
from .metrics import frequency, share_of_total, top_k
from .profile import column_profile, numeric_distribution, numeric_summary, profile_table
from .quality import (Rule, duplicate_keys, duplicate_keys_rule, duplicate_surplus, duplicate_surplus_modes,
                      iqr_fence, iqr_outliers, iqr_report, iqr_rule, missing_reference, missing_reference_rule, predicate_rule, run_rules,
                      surplus_rule)
from .quantiles import quantile_stats, quantiles
from .skew import hot_keys, salted_join
from .star import calendar_dimension

__all__ = [
    "IntegrityError", "Rule", "calendar_dimension", "check_orphans", "check_unique", "column_profile", "dedup",
    "duplicate_keys", "duplicate_keys_rule", "duplicate_surplus", "duplicate_surplus_modes", "enforce", "frequency", "hot_keys",
    "integrity_report", "iqr_fence", "iqr_outliers", "iqr_report", "iqr_rule", "latest_per_key", "missing_reference",
    "missing_reference_rule", "numeric_distribution", "numeric_summary", "predicate_rule", "profile_table",
    "quantile_stats", "quantiles", "row_conservation", "run_rules", "salted_join", "share_of_total",
    "surplus_rule", "top_k",
]
