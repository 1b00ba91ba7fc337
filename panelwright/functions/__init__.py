"""Column functions."""

from panelwright.functions.dates import (
    date_of_yyyymmdd,
    iso_date,
    month_index,
    month_of_yyyymm,
    month_of_text,
    year_of_yyyymm,
    year_of_yyyymmdd,
    yyyymm_of_date,
    yyyymm_of_yyyymmdd,
    yyyymmdd_of_date,
)
from panelwright.functions.values import (
    as_column,
    clamp,
    finite,
    first_chars,
    growth,
    integral_div,
    last_chars,
    number,
    positive,
    present,
    ratio,
    round_digits,
    row_total,
    sentinel_to_null,
    text_id,
    without_char,
)

__all__ = [
    "as_column",
    "clamp",
    "date_of_yyyymmdd",
    "finite",
    "first_chars",
    "growth",
    "integral_div",
    "iso_date",
    "last_chars",
    "month_index",
    "month_of_text",
    "month_of_yyyymm",
    "number",
    "positive",
    "present",
    "ratio",
    "round_digits",
    "row_total",
    "sentinel_to_null",
    "text_id",
    "without_char",
    "year_of_yyyymm",
    "year_of_yyyymmdd",
    "yyyymm_of_date",
    "yyyymm_of_yyyymmdd",
    "yyyymmdd_of_date",
]
