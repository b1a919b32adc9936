"""Fixed values.

Values that must equal the source project's for results to agree: text
formats, patterns, fill constants, labels, column lists and model settings.
They are stated once here, as plain text in their natural order.
"""

# --- fixed values: raw catalogue columns (all read as text) -----------------
RAW_COLUMNS = [
    "App Name",
    "App Id",
    "Category",
    "Rating",
    "Rating Count",
    "Installs",
    "Minimum Installs",
    "Maximum Installs",
    "Free",
    "Price",
    "Currency",
    "Size",
    "Minimum Android",
    "Developer Id",
    "Developer Website",
    "Developer Email",
    "Released",
    "Last Updated",
    "Content Rating",
    "Privacy Policy",
    "Ad Supported",
    "In App Purchases",
    "Editors Choice",
    "Scraped Time",
]

# --- fixed values: text parsing ---------------------------------------------
COUNT_STRIP_CHARS = "+,"              # "5,000+" -> "5000"
COMMA_STRIP_CHARS = ","               # "5,000"  -> "5000"
PRICE_STRIP_CHARS = "$"               # "$4.99"  -> "4.99"
SIZE_KEEP_PATTERN = "[^0-9.]"         # everything but digits and dot is removed
SIZE_UNITS = {"M": 1024.0, "k": 1.0}  # case-sensitive unit letters -> kilobytes
VERSION_PATTERN = "([0-9]+\\.?[0-9]*)"  # first version number, group 1
DATE_FORMAT = "MMM d, yyyy"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FLAG_TRUE = "true"
FLAG_FALSE = "false"
WEEKEND_DAYS = [1, 7]                 # dayofweek: 1 = Sunday, 7 = Saturday

# --- fixed values: cleaning ---------------------------------------------------
SIZE_ZERO = "0"
TEXT_FILLS = {
    "Developer Website": "Unknown",
    "Privacy Policy": "Unknown",
    "Minimum Android": "Varies with device",
}
CURRENCY_SENTINEL = "XXX"
CURRENCY_DEFAULT = "USD"
REQUIRED_COLUMNS = ["Developer Id", "Developer Email"]
OUTLIER_COLUMNS = [
    "Rating",
    "Rating Count",
    "Installs",
    "Price",
    "Size_KB",
    "Minimum Installs",
    "Maximum Installs",
]
OUTLIER_FENCE = 1.5
OUTLIER_QUANTILE_ERROR = 0.01
REFERENCE_DAY = "2026-03-05"

# --- fixed values: reduction --------------------------------------------------
REDUCTION_DROP = [
    "Installs",
    "Minimum Installs",
    "App Name",
    "App Id",
    "Developer Id",
    "Developer Website",
    "Developer Email",
    "Privacy Policy",
    "Scraped Time",
    "Currency",
    "Size",
    "Free",
]

# --- fixed values: features -------------------------------------------------------
ANALYSIS_NUMERIC = [
    "Rating",
    "Rating Count",
    "Price",
    "Size_KB",
    "min_android_version",
    "days_since_update",
    "app_age_days",
    "is_weekend_update",
]
EARLY_NUMERIC = [
    "Rating",
    "Rating Count",
    "Maximum Installs",
    "Price",
    "Size_KB",
    "min_android_version",
    "days_since_update",
    "app_age_days",
    "is_weekend_update",
]
ML_NUMERIC = [
    "Rating",
    "Rating Count",
    "Price",
    "Size_KB",
    "min_android_version",
    "days_since_update",
    "app_age_days",
    "is_weekend_update",
    "ad_supported_num",
    "in_app_purchases_num",
    "editors_choice_num",
]
IMPUTED_SUFFIX = "_imp"
TRANSFORMED_COLUMNS = [
    "Category",
    "Content Rating",
    "Minimum Android",
    "Released",
    "Last Updated",
    "Ad Supported",
    "In App Purchases",
    "Editors Choice",
    "Rating",
    "Rating Count",
    "Maximum Installs",
    "Price",
    "Size_KB",
    "min_android_version",
    "days_since_update",
    "app_age_days",
    "is_weekend_update",
    "category_index",
    "content_rating_index",
    "category_ohe",
    "content_rating_ohe",
    "numeric_features",
    "numeric_features_scaled",
    "features",
]
ML_PREPARED_COLUMNS = [
    "label",
    "Category",
    "Content Rating",
    "category_index",
    "content_rating_index",
    "category_ohe",
    "content_rating_ohe",
    "numeric_features",
    "numeric_features_scaled",
    "features",
]
SPLIT_WEIGHTS = [0.7, 0.3]
SPLIT_SEED = 42
FOREST_TREES = 20
FOREST_SEED = 12345

# --- fixed values: question labels -------------------------------------------------
FREE_LABEL = "Free"
PAID_LABEL = "Paid"
AGE_BAND_EDGES = [365, 1095, 1825]
AGE_BAND_LABELS = ["Less than 1 year", "1 to 3 years", "3 to 5 years", "More than 5 years"]
RATING_BUCKET_EDGES = [1.0, 2.0, 3.0, 4.0]
RATING_BUCKET_LABELS = ["0-1", "1-2", "2-3", "3-4", "4-5"]
RATING_RANGE = (0.0, 5.0)
