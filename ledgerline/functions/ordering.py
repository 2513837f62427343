"""Sort keys with the reference engine's NULL placement (NULLs last both ways)."""

from __future__ import annotations

from pyspark.sql import Column

from ledgerline.functions.casts import _col


def asc(c) -> Column:
    return _col(c).asc_nulls_last()


def desc(c) -> Column:
    return _col(c).desc_nulls_last()


def sort_spec(order) -> list[Column]:
    """Turn ``["a", ("b", False)]`` into NULLS-LAST sort columns (False = DESC)."""
    out = []
    for o in order:
        if isinstance(o, tuple):
            name, ascending = o
            out.append(asc(name) if ascending else desc(name))
        elif isinstance(o, Column):
            out.append(o)
        else:
            out.append(asc(o))
    return out
