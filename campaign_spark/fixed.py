"""Fixed values.

These must equal the analysed campaign pipeline's for equal results; they
are listed plainly, in their natural order, in one place.
"""

# --- fixed values: missing-value label and value-count text ---------------
NA_LABEL = "NA"
COUNT_PAIR_SEPARATOR = ": "
COUNT_ITEM_SEPARATOR = ";; "

# --- fixed values: city-code compliance -------------------------------------
CODE_SEPARATOR = "-"
CODE_PARTS = 3
COMPLIANT_LABEL = "compliant"

# --- fixed values: cleansing --------------------------------------------------
# A missing goal type is the third goal type; a missing conversion counts as
# converted; impressions and clicks take the median of their (country, region).
FILL_CONSTANTS = {"goal_type": 3.0, "conversions": 1.0}
INT_COLUMNS = ["goal_type"]
MEDIAN_COLUMNS = ["impressions", "clicks"]
MEDIAN_KEYS = ["country", "region"]

# --- fixed values: efficiency ratios (output: numerator, denominator) --------
RATIOS = {
    "im_cpm": ("impressions", "total_spend_cpm"),
    "clicks_cpm": ("clicks", "total_spend_cpm"),
    "conversions_cpm": ("conversions", "total_spend_cpm"),
    "clicks_im": ("clicks", "impressions"),
    "conversions_im": ("conversions", "impressions"),
    "conversions_clicks": ("conversions", "clicks"),
}

# --- fixed values: calendar features ----------------------------------------
YEAR_MONTH_FORMAT = "yyyyMM"

# --- fixed values: profiling --------------------------------------------------
TOP_K = 10
CATEGORICAL = ["business_vertical", "country", "region", "city_code", "strategy_id", "channel_name",
               "goal_type", "year_captured", "yyyymm_captured", "conversions"]
NUMERIC = ["total_spend_cpm", "impressions", "clicks"]

# --- fixed values: running totals ---------------------------------------------
RUNNING_KEYS = ["channel_name", "region"]
RUNNING_OUTPUT_ORDER = ["channel_name", "region", "captured_date"]

# --- fixed values: categories of an item ----------------------------------------
CATEGORY_SEPARATOR = "|"

# --- fixed values: modelling splits (days before the last date) ---------------
SPLITS = [("train", 14), ("validation", 7), ("test", 0)]
LABEL_DAYS = 7
