"""Column-expression builders: everything here returns a ``Column`` and runs
inside whole-stage codegen (no Python UDF)."""

from catalytics.functions.buckets import bucketize, two_way
from catalytics.functions.dates import days_since, weekend_flag
from catalytics.functions.parse import (
    coerce_double,
    coerce_long,
    flag_to_number,
    free_flag,
    parse_count,
    parse_date,
    parse_double,
    parse_flag,
    parse_price,
    parse_size_kb,
    parse_timestamp,
    parse_version,
    replace_sentinel,
)

__all__ = [
    "bucketize",
    "coerce_double",
    "coerce_long",
    "days_since",
    "flag_to_number",
    "free_flag",
    "parse_count",
    "parse_date",
    "parse_double",
    "parse_flag",
    "parse_price",
    "parse_size_kb",
    "parse_timestamp",
    "parse_version",
    "replace_sentinel",
    "two_way",
    "weekend_flag",
]
