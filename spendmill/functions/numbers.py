"""Numbers: metric text, micros, totals over nested lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendmill.fixed_values import MICROS_PER_UNIT


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros_to_units(micros: Column | str) -> Column:
    """Currency units of an integer micros amount, null for null."""
    return _col(micros) / F.lit(float(MICROS_PER_UNIT))


def to_micros(amount: Column | str) -> Column:
    """Integer micros of a fractional amount.

    Sums over the result are exact, so a total does not depend on how Spark splits and orders the rows. An amount that is
    not finite, or too large for a whole number, has no micros: it gives null and does not fail the query.
    """
    return F.rint(_col(amount) * F.lit(float(MICROS_PER_UNIT))).try_cast("bigint")


def _whole(text: Column) -> Column:
    return text.try_cast("bigint")


def _number(text: Column) -> Column:
    # Java would accept a type suffix ("1d", "1f"), which is no number in a report; "inf" is one.
    suffixed = F.lower(F.right(F.rtrim(text), F.lit(1))).isin("d", "f")
    return F.when(~suffixed | text.rlike(r"(?i)inf\s*$"), text.try_cast("double"))


def whole_number_or_zero(text: Column | str) -> Column:
    """Integer of a metric text; a missing metric counts as 0."""
    return F.coalesce(_whole(_col(text)), F.lit(0).cast("bigint"))


def number_or_zero(text: Column | str) -> Column:
    """Double of a metric text; a missing metric counts as 0.0."""
    return F.coalesce(_number(_col(text)), F.lit(0.0))


def bad_whole_number(text: Column | str) -> Column:
    """True for text that is there but is no integer ("12.0" is none)."""
    return _col(text).isNotNull() & _whole(_col(text)).isNull()


def bad_number(text: Column | str) -> Column:
    """True for text that is there but is no number."""
    return _col(text).isNotNull() & _number(_col(text)).isNull()


def list_total(items: Column | str, member: str = "value") -> Column:
    """Sum of one member over a nested list, in list order; a missing list sums to 0.0."""
    total = F.aggregate(items, F.lit(0.0), lambda acc, item: acc + _number(item[member]))
    return F.coalesce(total, F.lit(0.0))


def bad_list_values(items: Column | str, member: str = "value") -> Column:
    """True when some list element has no number in the member."""
    return F.coalesce(F.exists(items, lambda item: _number(item[member]).isNull()), F.lit(False))
