from millrace.functions.encode import (
    indicator,
    indicators,
    normalise_code,
    number_or,
    recode,
    recode_by_substring,
    two_level,
)
from millrace.functions.numeric import (
    bin_percent,
    bucket_by_last_digit,
    bucket_nearest,
    mean_across,
    mean_abs_across,
    round_half_up,
    truncated_mean_abs_across,
    whole_percent,
)
from millrace.functions.text import (
    ONE_DIGIT_FRACTION,
    OPTIONAL_DIGITS,
    SIGNED_DECIMAL,
    is_number,
    render_list,
    split_fields,
    tokens,
)

__all__ = [
    "ONE_DIGIT_FRACTION",
    "OPTIONAL_DIGITS",
    "SIGNED_DECIMAL",
    "bin_percent",
    "bucket_by_last_digit",
    "bucket_nearest",
    "indicator",
    "indicators",
    "is_number",
    "mean_abs_across",
    "mean_across",
    "normalise_code",
    "number_or",
    "recode",
    "recode_by_substring",
    "render_list",
    "round_half_up",
    "split_fields",
    "tokens",
    "truncated_mean_abs_across",
    "two_level",
    "whole_percent",
]
