"""Tolerant text-to-number conversion under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number. A plain cast would also take '5d', 'NaN' or '0x1p3'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def decimal_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def number_or_zero(text: Column) -> Column:
    """Double; 0 where the text is no number. ``text`` should be a plain column: it is
    read more than once."""
    return F.coalesce(decimal_number(text.cast("string")), F.lit(0.0))


def count_or_zero(text: Column) -> Column:
    """Whole number; 0 where the text is no number. A text with a point is never cast
    whole: each such try would raise and catch an error inside Spark."""
    text = text.cast("string")
    return F.coalesce(
        F.when(~text.contains("."), text.try_cast("bigint")),
        decimal_number(text).try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )
