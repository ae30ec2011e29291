"""Column functions."""

from .scalars import (
    error_rate,
    mismatch_count,
    mismatch_places,
    null_if_missing,
    parse_yes,
    percentage,
    r_round,
    split_tokens,
    trim_white,
    trimmed,
    yes_no,
)

__all__ = ["error_rate", "mismatch_count", "mismatch_places", "null_if_missing", "parse_yes", "percentage", "r_round", "split_tokens", "trim_white", "trimmed", "yes_no"]
