"""Text: resource names, defaults, account prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def last_segment(resource: Column | str, separator: str, blank_as_null: bool = False) -> Column:
    """Part after the last separator; the whole text when there is no separator."""
    tail = F.substring_index(_col(resource), separator, -1)
    return F.when(_col(resource) != "", tail) if blank_as_null else tail


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(_col(text), F.lit(""))


def default_if_blank(text: Column | str, default: Column | str) -> Column:
    """The text, or the default when it is null or empty."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(blank_to_null(text), fallback)


def with_prefix(text: Column | str, prefix: str) -> Column:
    return F.when(_col(text).startswith(prefix), _col(text)).otherwise(F.concat(F.lit(prefix), _col(text)))


def without_prefix(text: Column | str, prefix: str) -> Column:
    """Text with every occurrence of the prefix removed."""
    return F.replace(_col(text), F.lit(prefix), F.lit(""))


def drop_blanks(items: Column) -> Column:
    return F.filter(items, lambda item: item.isNotNull() & (item != ""))
