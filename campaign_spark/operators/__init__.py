"""Relational operators of the campaign and ratings analytics, each a
``DataFrame -> DataFrame`` function built from Spark's own operators."""

from campaign_spark.operators.aggregates import (
    efficiency_by, ratio_of_sums_by, totals_by, totals_by_sets, with_ratios,
)
from campaign_spark.operators.filters import filter_rows, having, non_null_rows, null_rows
from campaign_spark.operators.impute import cast_int, cleanse, fill_constants, impute_group_median
from campaign_spark.operators.joins import Dimension, attach_group_value, fits_broadcast, maybe_broadcast, star_join
from campaign_spark.operators.modelling import model_dataset, prediction_points
from campaign_spark.operators.ordering import in_order, ranked, with_before, written
from campaign_spark.operators.popularity import category_popularity, item_popularity, item_stats
from campaign_spark.operators.profile import (
    code_compliance, group_distinct_counts, group_value_histogram, null_coverage_gaps,
    numeric_profile, repeated_pairs,
)
from campaign_spark.operators.quantiles import group_medians, group_quantiles, quantiles_long
from campaign_spark.operators.setops import (
    distinct_keys, distinct_values, drop_duplicate_keys, key_difference, union_all,
)
from campaign_spark.operators.splits import last_date_per, split_on_last_date, with_last_date
from campaign_spark.operators.windows import (
    distinct_value_counts, running_totals, simple_value_counts, value_counts, value_counts_within,
)

__all__ = [name for name in dir() if not name.startswith("_")]
