"""Lenient reading of text values: what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Java parser behind the cast also takes "3d", "NaN" and "Infinity".
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(text: Column) -> Column:
    value = text.cast("string")
    return F.when(value.rlike(_PLAIN_NUMBER), value.try_cast("double"))


def lenient_long(text: Column) -> Column:
    """Whole number, also from texts such as ``3.0``; fractions are cut off.

    Plain digits are read directly: going through double would lose the last
    digits of ids above 2**53. Other texts are not tried as whole numbers, since a
    failed cast costs a Java exception per row.
    """
    value = text.cast("string")
    whole = F.when(value.rlike(_WHOLE_NUMBER), value.try_cast("bigint"))
    return F.coalesce(whole, lenient_double(value).try_cast("bigint"))


def lenient_time(text: Column) -> Column:
    """Time in the session zone (UTC); an offset in the text is applied."""
    return text.cast("string").try_cast("timestamp")
