"""Column expressions. All of them stay inside the JVM; none is a Python UDF."""

from spendmill.functions.assets import asset_headlines, asset_descriptions
from spendmill.functions.creative import creative_detail
from spendmill.functions.dates import lenient_date, strict_date
from spendmill.functions.numbers import (
    bad_list_values,
    bad_number,
    bad_whole_number,
    list_total,
    micros_to_units,
    number_or_zero,
    to_micros,
    whole_number_or_zero,
)
from spendmill.functions.text import (
    blank_to_null,
    default_if_blank,
    drop_blanks,
    last_segment,
    with_prefix,
    without_prefix,
)

__all__ = [
    "asset_descriptions",
    "asset_headlines",
    "bad_list_values",
    "bad_number",
    "bad_whole_number",
    "blank_to_null",
    "creative_detail",
    "default_if_blank",
    "drop_blanks",
    "last_segment",
    "lenient_date",
    "list_total",
    "micros_to_units",
    "number_or_zero",
    "strict_date",
    "to_micros",
    "whole_number_or_zero",
    "with_prefix",
    "without_prefix",
]
