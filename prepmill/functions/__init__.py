"""Column expressions: text clean-up, tolerant casts, binning and conditional values."""

from prepmill.functions.bins import TIME_OF_DAY, Bin, bin_by, time_of_day
from prepmill.functions.values import (
    before_dash,
    decode_two_way,
    keep_or_replace,
    percent_to_double,
    strip_trailing_percent,
    text_to_double,
    to_double,
    words_to_double,
)

__all__ = [
    "TIME_OF_DAY",
    "Bin",
    "before_dash",
    "bin_by",
    "decode_two_way",
    "keep_or_replace",
    "percent_to_double",
    "strip_trailing_percent",
    "text_to_double",
    "time_of_day",
    "to_double",
    "words_to_double",
]
