"""Column-level helpers: built-in Spark expressions only (no Python UDFs)."""

from campaign_spark.functions.calendar import year_of, year_month_of
from campaign_spark.functions.nulls import na_label, nonnull_sum, null_safe_differs
from campaign_spark.functions.ratios import RATIOS, exact_sum, from_units, safe_ratio, to_units
from campaign_spark.functions.text import code_compliance_label, count_text

__all__ = [
    "year_of", "year_month_of", "na_label", "nonnull_sum", "null_safe_differs",
    "RATIOS", "safe_ratio", "exact_sum", "to_units", "from_units", "code_compliance_label", "count_text",
]
