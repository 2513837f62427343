"""Category normalisers: province spellings and age buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.casts import _col

# --- fixed values (must equal the reference for identical results) ---------
# Province spellings, matched after UPPER(TRIM(x)), and the name each maps to.
# Anything not listed keeps its trimmed input (so 'EASTERNCAPE' or 'GP' pass
# through unchanged, as in the reference).
PROVINCE_SPELLINGS = {
    "Limpopo": ["LP", "LIMPOPO"],
    "Mpumalanga": ["MP", "MPUMALANGA"],
    "Gauteng": ["GT", "GAUTENG"],
    "KwaZulu-Natal": ["KZN", "KWAZULU-NATAL", "KWAZULU NATAL"],
    "NorthWest": ["NW", "NORTH WEST"],
    "EasternCape": ["EC", "EASTERN CAPE"],
    "WesternCape": ["WC", "WESTERN CAPE"],
    "NorthernCape": ["NC", "NORTHERN CAPE"],
    "FreeState": ["FS", "FREE STATE"],
}

# Age buckets on CorrectedAge: [lower, upper) bounds and labels; NULL -> NULL.
AGE_BUCKETS = [
    (None, 20, "Teen"),
    (20, 30, "Young Adult"),
    (30, 60, "Adult"),
    (60, None, "Pensioner"),
]
# ----------------------------------------------------------------------------


def normalise_province(c, spellings: dict | None = None) -> Column:
    """Map known spellings to one form; unknown values keep ``TRIM(x)``.

    Implemented as a literal map lookup (a single codegen'd expression, no
    join), falling back to the trimmed input."""
    spellings = spellings or PROVINCE_SPELLINGS
    pairs = []
    for name, keys in spellings.items():
        for k in keys:
            pairs += [F.lit(k), F.lit(name)]
    lookup = F.create_map(*pairs)
    x = _col(c)
    return F.coalesce(F.try_element_at(lookup, F.upper(F.trim(x))), F.trim(x))


def age_category(c, buckets=None) -> Column:
    """``CASE`` chain generated from half-open bounds; NULL age gives NULL."""
    buckets = buckets or AGE_BUCKETS
    x = _col(c)
    out = None
    for lo, hi, label in buckets:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & (x < F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(out)
