"""Column functions: every one returns a Spark ``Column`` built from built-ins."""

from .jsontext import (accident_flag, json_list_size, json_preview, owner_count,
                       service_event_count)
from .numeric import (age_in_years, bucket_ordinal, bucketize, clip, compare_to_band,
                      guarded_ratio, half_even, number_or_null, whole_number_or_null)
from .text import clean_upper, is_blank, is_filled, snake_case, snake_name, strip, zip5
from .time import days_since, iso_utc, timestamp_or_null

__all__ = [
    "accident_flag", "age_in_years", "bucket_ordinal", "bucketize", "clean_upper",
    "clip", "compare_to_band", "days_since", "guarded_ratio", "half_even",
    "is_blank", "is_filled", "iso_utc", "json_list_size", "json_preview",
    "number_or_null", "owner_count", "service_event_count", "snake_case",
    "snake_name", "strip", "timestamp_or_null", "whole_number_or_null", "zip5",
]
