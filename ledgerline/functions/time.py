"""Calendar helpers: month spine and wall-clock zone conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.casts import _col

# --- fixed values ------------------------------------------------------------
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]

# Zone abbreviations are ambiguous in Spark (BST resolves to Bangladesh, IST to
# India, PDT is rejected), so abbreviations are mapped to region ids first.
ZONE_ALIASES = {
    "GMT": "Europe/London", "BST": "Europe/London", "UTC": "UTC",
    "SAST": "Africa/Johannesburg", "CAT": "Africa/Maputo",
    "CET": "Europe/Paris", "CEST": "Europe/Paris",
    "EST": "America/New_York", "EDT": "America/New_York",
    "CST": "America/Chicago", "CDT": "America/Chicago",
    "MST": "America/Denver", "MDT": "America/Denver",
    "PST": "America/Los_Angeles", "PDT": "America/Los_Angeles",
    "IST": "Asia/Kolkata",
}
# -----------------------------------------------------------------------------


def month_periods() -> list[tuple[int, str]]:
    """The 12-row months dimension as (MonthID, MonthName) pairs."""
    return list(enumerate(MONTH_NAMES, start=1))


def zone_id(c) -> Column:
    pairs = []
    for k, v in ZONE_ALIASES.items():
        pairs += [F.lit(k), F.lit(v)]
    x = F.trim(_col(c))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(x)), x)


def to_zone(ts, source_zone, target_zone: str = "Europe/London") -> Column:
    """Wall-clock ``ts`` recorded in ``source_zone`` (a column of zone names)
    re-expressed as wall-clock time in ``target_zone``; NULL zone keeps ``ts``."""
    t = _col(ts).cast("timestamp_ntz")
    z = zone_id(source_zone)
    return F.when(z.isNull(), t).otherwise(F.convert_timezone(z, F.lit(target_zone), t))
