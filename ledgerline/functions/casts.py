"""Safe casts and rounding with the numeric behaviour of the reference SQL.

The reference cleans columns with ``TRY_CAST(TRIM(x) AS ...)`` and casts
doubles to integers with ``CAST(x AS INTEGER)``.  Spark's plain casts differ
in three places, fixed here:

* text -> integer: ``'1863.84'`` is NULL in Spark but 1864 in the reference
  engine (text is rounded half away from zero);
* double -> integer: Spark truncates (3.5 -> 3), the reference rounds half to
  even (2.5 -> 2, 3.5 -> 4);
* two-decimal rounding of the pandas model is numpy's half-even
  ``rint(x * 100) / 100`` (0.125 -> 0.12), not SQL ``round`` (0.13).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """``TRIM(x)`` for a column of any type (numbers go through their text form)."""
    return F.trim(_col(c).cast("string"))


def try_double(c) -> Column:
    """``TRY_CAST(TRIM(x) AS DOUBLE)``: unparsable text becomes NULL, never an error."""
    return text(c).try_cast("double")


def try_int(c) -> Column:
    """``TRY_CAST(TRIM(x) AS INTEGER)``: decimal text is rounded half away from
    zero (``'1863.84'`` -> 1864); unparsable or out-of-range text is NULL."""
    as_double = try_double(c)
    return F.round(as_double, 0).try_cast("int")


def sql_int(c, type_name: str = "int") -> Column:
    """``CAST(x AS INTEGER)`` for a double, rounding half to even (2.5 -> 2).

    Overflow raises under ANSI like the reference; pass ``type_name='bigint'``
    where a sum may exceed the int range."""
    return F.rint(_col(c)).cast(type_name)


def half_even(c, digits: int = 2) -> Column:
    """numpy/pandas ``Series.round(digits)``: ``rint(x * 10^d) / 10^d``."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def clip(c, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas ``clip``: NULL/NaN stays NULL/NaN (``greatest(NULL, 0)`` would be 0)."""
    x = _col(c)
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(x.isNull() | F.isnan(x), x).otherwise(out)
