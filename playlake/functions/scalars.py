"""Small column expressions for cleaning and casting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TEXT_WIDTH


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value: Column | str) -> Column:
    """NaN becomes NULL; other values, NULL included, stay."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def blank_to_null(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value != "", value)


def to_id(value: Column | str) -> Column:
    """Text as a bigint identifier; blanks and non-numbers become NULL instead of failing the job."""
    return _col(value).try_cast("bigint")


def to_float(value: Column | str) -> Column:
    """Single-precision value. Not for join keys: the narrowing breaks equality with doubles."""
    return _col(value).try_cast("float")


def round_to_int(value: Column | str) -> Column:
    """Nearest int, halves away from zero (a plain cast would truncate)."""
    return F.round(_col(value)).cast("int")


def clip_text(value: Column | str, width: int = TEXT_WIDTH) -> Column:
    """The first ``width`` characters."""
    return F.left(_col(value), F.lit(width))


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; NULL when either part is missing."""
    return F.concat(_col(first), F.lit(" "), _col(last))
