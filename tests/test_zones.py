"""Hours that a clock change skips or repeats."""

from datetime import datetime as D

import pytest

from conftest import SF_SMALL, rows
from ledgerline.functions.zones import clock_changes, to_zone_by_choice
from ledgerline.sources import roles

TIMES = [("EDT", D(1995, 4, 2, 2, 30)), ("EST", D(1995, 10, 29, 1, 30)), ("EST", D(1995, 10, 29, 2, 0)), ("EST", D(1995, 10, 29, 0, 59)),
         (" bst ", D(1995, 3, 26, 1, 0)), ("BST", D(1995, 10, 22, 1, 59)), ("SAST", D(1995, 3, 26, 1, 0)), (None, D(1995, 3, 26, 1, 0)),
         ("UTC", None)]


def test_changes_follow_the_tz_database():
    york = [c for c in clock_changes("America/New_York", 1995, 1995)]
    assert york == [("skipped", D(1995, 4, 2, 2), D(1995, 4, 2, 3), -18000, -14400),
                    ("repeated", D(1995, 10, 29, 1), D(1995, 10, 29, 2), -14400, -18000)]
    assert clock_changes("UTC") == () and clock_changes("Africa/Johannesburg", 1980) == ()
    assert all((until - start).total_seconds() == abs(a - b) for _, start, until, b, a in clock_changes("Europe/London"))


def test_choices(spark):
    df = spark.createDataFrame([(i, z, t) for i, (z, t) in enumerate(TIMES)], "i int, z string, t timestamp_ntz")
    out = to_zone_by_choice(df, "t", "z", {"a": ("earlier", "earlier"), "b": ("later", "later"), "c": ("null", "later"), "d": ("later", "null")},
                            target="UTC", kind="k")
    got = {r[0]: r[1:] for r in rows(out, "i", "k", "a", "b", "c", "d")}
    assert got[0] == ("skipped", D(1995, 4, 2, 6, 30), D(1995, 4, 2, 7, 30), D(1995, 4, 2, 7, 30), None)
    assert got[1] == ("repeated", D(1995, 10, 29, 5, 30), D(1995, 10, 29, 6, 30), None, D(1995, 10, 29, 6, 30))
    assert got[2] == (None, *[D(1995, 10, 29, 7, 0)] * 4) and got[3] == (None, *[D(1995, 10, 29, 4, 59)] * 4)
    assert got[4] == ("skipped", D(1995, 3, 26, 0), D(1995, 3, 26, 1), D(1995, 3, 26, 1), None)
    assert got[5] == ("repeated", D(1995, 10, 22, 0, 59), D(1995, 10, 22, 1, 59), None, D(1995, 10, 22, 1, 59))
    assert got[6] == (None, *[D(1995, 3, 25, 23)] * 4) and got[7] == (None, *[D(1995, 3, 26, 1)] * 4) and got[8] == (None,) * 5


def test_unknown_zones_years_and_choices_are_errors(spark):
    for zone, year in (("Asia/Tokyo", 1995), ("UTC", 1950)):
        df = spark.createDataFrame([(zone, D(year, 1, 1))], "z string, t timestamp_ntz")
        with pytest.raises(Exception, match="no clock changes known"):
            to_zone_by_choice(df, "t", "z", {"a": ("later", "later")}).collect()
    with pytest.raises(ValueError):
        to_zone_by_choice(df, "t", "z", {"a": ("later", "never")})


def test_registered_times_fall_into_both_changes(spark):
    out = to_zone_by_choice(roles.night_repayments(spark, SF_SMALL.replace("sf0.001", "sf0.01")), "RepaymentDate", "TimeZone",
                            {"a": ("later", "later")}, kind="k")
    assert {r.k for r in out.select("k").distinct().collect()} == {None, "skipped", "repeated"}
