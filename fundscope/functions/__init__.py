"""Column expressions built from Spark's own functions (no UDFs)."""

from .fiscal import fiscal_year, fy_amount_columns, fy_column_name, in_fy, in_report_range, in_window
from .names import first_last, is_blank, kept_owner, last_first, last_first_comma, sort_name, team_flag, text
from .rules import threshold_ladder, visit_qualifies
from .tiers import combine_tiers, numeric_tier, segment_code, tier_label

__all__ = ["fiscal_year", "fy_amount_columns", "fy_column_name", "in_fy", "in_report_range",
           "in_window", "first_last", "is_blank", "kept_owner", "last_first", "last_first_comma",
           "sort_name", "team_flag", "text", "threshold_ladder", "visit_qualifies", "combine_tiers",
           "numeric_tier", "segment_code", "tier_label"]
