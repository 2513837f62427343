"""Wall-clock times in the hours that a clock change skips or repeats.

Where the clock goes forward, an hour of wall-clock times never happens; where it goes back, an hour happens
twice.  Engines differ in silence: Spark takes the first of a repeated hour, the reference's engine the second.  Here the
choice is a parameter.  The changes of the zones are a table, made from the tz database by a rule: two rows a
year and zone, whatever the data.  Times are looked up by zone and day, then by interval.

Times outside those intervals have one meaning and never need the table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.time import ZONE_ALIASES, zone_id

ZONES = tuple(sorted(set(ZONE_ALIASES.values())))
YEARS = (1970, 2037)
STEP_DAYS = 7               # two changes of a zone are further apart
CHOICES = ("earlier", "later", "null")
_TABLE = ("_c_zone string, _c_day date, _c_kind string, _c_from timestamp_ntz, _c_until timestamp_ntz, "
          "_c_before int, _c_after int")


def _offset(zone: ZoneInfo, instant: datetime) -> timedelta:
    return instant.astimezone(zone).utcoffset()


@lru_cache(maxsize=64)
def clock_changes(zone: str, first: int = YEARS[0], last: int = YEARS[1]) -> tuple[tuple, ...]:
    """``(kind, from, until, before, after)`` of every change of a zone in these years: the wall-clock times from
    ``from`` until before ``until`` are ``skipped`` or ``repeated``; the offsets from UTC are in seconds."""
    info, out = ZoneInfo(zone), []
    at, end = datetime(first, 1, 1, tzinfo=timezone.utc), datetime(last + 1, 1, 1, tzinfo=timezone.utc)
    while at < end:
        low, high = at, min(at + timedelta(days=STEP_DAYS), end)
        at = high
        before, after = _offset(info, low), _offset(info, high)
        if before == after:
            continue
        while high - low > timedelta(seconds=1):
            middle = low + (high - low) // 2
            middle -= timedelta(microseconds=middle.microsecond)
            if middle <= low:
                break
            low, high = (low, middle) if _offset(info, middle) != before else (middle, high)
        old, new = ((high + x).replace(tzinfo=None) for x in (before, after))
        kind = "skipped" if new > old else "repeated"
        out.append((kind, min(old, new), max(old, new), int(before.total_seconds()), int(after.total_seconds())))
    return tuple(out)


def change_table(spark, zones: tuple[str, ...] = ZONES, years: tuple[int, int] = YEARS) -> DataFrame:
    """One row per zone, change and day that its interval touches."""
    rows = []
    for zone in zones:
        for kind, start, until, before, after in clock_changes(zone, *years):
            day = start.date()
            while day <= (until - timedelta(microseconds=1)).date():
                rows.append((zone, day, kind, start, until, before, after))
                day += timedelta(days=1)
    return spark.createDataFrame(rows, _TABLE)


def to_zone_by_choice(df: DataFrame, ts: str, zone: str, outs: dict[str, tuple[str, str]], target: str = "Europe/London",
                      kind: str | None = None, zones: tuple[str, ...] = ZONES, years: tuple[int, int] = YEARS) -> DataFrame:
    """Wall-clock ``ts`` of the zone named in column ``zone`` as wall-clock time in ``target``.

    ``outs``: for each new column what a time means in a repeated and in a skipped hour, each ``"earlier"``,
    ``"later"`` (the instant that comes first or last of the two that it may be; for a skipped hour those by the clock
    after and before the change) or ``"null"``.  The reference's engine is ``("later", "later")``, Spark's
    own conversion ``("earlier", "later")``.  ``kind`` names a column that says ``skipped`` or ``repeated``, else NULL.

    A NULL zone keeps the time, as :func:`~ledgerline.functions.time.to_zone`.  A zone or a year that the table was not made
    for is an error, not another choice in silence."""
    for choices in outs.values():
        if len(choices) != 2 or any(c not in CHOICES for c in choices):
            raise ValueError(f"a choice for repeated and one for skipped hours, of {CHOICES}: {choices!r}")
    spark = df.sparkSession
    t, z = F.col(ts).cast("timestamp_ntz"), zone_id(zone)
    table = change_table(spark, zones, years)
    near = (F.col("_c_zone") == z) & (F.col("_c_day") == F.to_date(t))
    found = df.join(table, near & (t >= F.col("_c_from")) & (t < F.col("_c_until")), "left")
    known = z.isin(*zones) & F.year(t).between(*years)
    checked = F.when(known | t.isNull(), z).otherwise(F.raise_error(F.concat(
        F.lit("no clock changes known for "), z, F.lit(" at "), F.coalesce(t.cast("string"), F.lit("")))))

    def instant(repeated: str, skipped: str) -> Column:
        by = {"earlier": {"repeated": F.col("_c_before"), "skipped": F.col("_c_after")},
              "later": {"repeated": F.col("_c_after"), "skipped": F.col("_c_before")}}
        offset = F.lit(None).cast("int")
        for name, choice in (("repeated", repeated), ("skipped", skipped)):
            if choice != "null":
                offset = F.when(F.col("_c_kind") == name, by[choice][name]).otherwise(offset)
        odd = t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset)
        return F.when(F.col("_c_kind").isNotNull(), odd).otherwise(F.convert_timezone(checked, F.lit("UTC"), t))
    new = [F.when(z.isNull(), t).otherwise(F.convert_timezone(F.lit("UTC"), F.lit(target), instant(*c))).alias(name)
           for name, c in outs.items()]
    if kind:
        new.append(F.col("_c_kind").alias(kind))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *new)
