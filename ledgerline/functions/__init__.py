"""Column-level helpers; every one returns a ``Column`` built from Spark
built-ins so it stays inside whole-stage codegen."""

from ledgerline.functions.casts import (
    clip, half_even, sql_int, text, try_double, try_int,
)
from ledgerline.functions.categories import age_category, normalise_province
from ledgerline.functions.ordering import asc, desc, sort_spec
from ledgerline.functions.time import MONTH_NAMES, month_periods, to_zone

__all__ = [
    "text", "try_double", "try_int", "sql_int", "half_even", "clip",
    "normalise_province", "age_category", "asc", "desc", "sort_spec",
    "to_zone", "MONTH_NAMES", "month_periods",
]
