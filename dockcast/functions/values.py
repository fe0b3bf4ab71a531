"""Number and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(c: Column) -> Column:
    """A double, or NULL where the value is not a number; NaN counts as NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def clip(c: Column, lower: Column | float | None = None, upper: Column | float | None = None) -> Column:
    """Bound a value; NULL stays NULL (greatest and least alone would skip it)."""
    bounded = c
    if lower is not None:
        bounded = F.greatest(bounded, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(c.isNotNull(), bounded)


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the nearest even whole number, scale back: the rule of numeric arrays."""
    scale = F.lit(10.0**digits)
    return F.rint(c * scale) / scale


def sanitize(c: Column) -> Column:
    """Keep letters, digits, '-' and '_' only, for use in a file name."""
    return F.regexp_replace(c.cast("string"), r"[^\p{L}\p{N}_-]", "")


def slot_folder(label: Column) -> Column:
    """'09:00' → '0900'."""
    return F.replace(label, F.lit(":"), F.lit(""))


def slot_from_path(path: Column) -> Column:
    """'…/slots/0900/…' → '09:00'; NULL where the path has no such part."""
    digits = F.regexp_extract(path, r"/slots/(\d{4})/", 1)
    return F.when(digits != "", F.regexp_replace(digits, r"(\d{2})(\d{2})", "$1:$2"))
