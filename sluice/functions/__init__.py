"""Column helpers: text, numbers, times and labels."""

from sluice.functions.labels import is_critical, is_warning, risk_band
from sluice.functions.numbers import to_number
from sluice.functions.text import (
    as_json,
    nullify,
    norm_code,
    norm_id,
    quoted,
    title_case,
    to_flag,
    trim_upper,
)
from sluice.functions.times import hours_between, to_dt, to_ts

__all__ = [
    "as_json",
    "hours_between",
    "is_critical",
    "is_warning",
    "norm_code",
    "norm_id",
    "nullify",
    "quoted",
    "risk_band",
    "title_case",
    "to_dt",
    "to_flag",
    "to_number",
    "to_ts",
    "trim_upper",
]
