import datetime as dt

from conftest import rows
from ledgerline.operators import calendar as cal


def _facts(spark, data):
    return spark.createDataFrame(data, "CustomerID int, RepaymentDate timestamp_ntz, "
                                       "Amount int, TimeZone string")


def test_hours_inclusive_and_null_amount_counted(spark):
    ents = spark.createDataFrame([(1,)], "CustomerID int")
    d = dt.datetime
    facts = _facts(spark, [(1, d(2024, 3, 1, 5, 59), 1, "UTC"), (1, d(2024, 3, 1, 6, 0), 2, "UTC"),
                           (1, d(2024, 3, 1, 18, 59), 3, "UTC"), (1, d(2024, 3, 1, 19, 0), 4, "UTC"),
                           (1, d(2024, 3, 2, 12, 0), None, "UTC")])
    out = rows(cal.dense_calendar(ents, facts, sort=True))
    assert len(out) == 12
    assert out[2] == (1, "March", 3, 5.0)
    assert all(r[2] == 0 and r[3] == 0.0 for i, r in enumerate(out) if i != 2)


def test_months_merge_across_years_and_duplicate_entities_repeat(spark):
    ents = spark.createDataFrame([(1,), (1,), (2,)], "CustomerID int")
    d = dt.datetime
    facts = _facts(spark, [(1, d(2023, 5, 1, 9), 10, "UTC"), (1, d(2024, 5, 1, 9), 5, "UTC")])
    out = rows(cal.dense_calendar(ents, facts, sort=True))
    assert len(out) == 36
    may = [r for r in out if r[1] == "May"]
    assert may == [(1, "May", 2, 15.0), (1, "May", 2, 15.0), (2, "May", 0, 0.0)]


def test_zone_shift_moves_hour(spark):
    ents = spark.createDataFrame([(1,)], "CustomerID int")
    facts = _facts(spark, [(1, dt.datetime(2024, 7, 1, 7, 30), 5, "America/New_York"),
                           (1, dt.datetime(2024, 7, 1, 2, 30), 7, "America/New_York")])
    plain = rows(cal.dense_calendar(ents, facts, sort=True))
    london = rows(cal.dense_calendar(ents, facts, zone_col="TimeZone", sort=True))
    assert plain[6] == (1, "July", 1, 5.0)      # 02:30 is outside 6..18 in its own zone
    assert london[6] == (1, "July", 2, 12.0)    # 12:30 and 07:30 in London


def test_pivot_rounds_each_row_half_even(spark):
    tl = spark.createDataFrame([(1, "January", 1, 0.5), (1, "February", 1, 1.5),
                                (1, "March", 1, 2.5)],
                               "CustomerID int, MonthName string, NumberOfRepayments long, "
                               "AmountTotal double")
    out = cal.pivot_calendar(tl).first()
    assert (out["January_Total"], out["February_Total"], out["March_Total"]) == (0, 2, 2)
    assert out["January_Repayments"] == 1 and out["April_Repayments"] is None
    cp = cal.conditional_pivot(tl).first()
    assert cp["JanuaryRepayments"] == 1 and cp["MarchTotal"] == 2.5


def test_pivot_totals_equal_timeline_totals(spark):
    from ledgerline.sources import roles
    from conftest import SF_SMALL
    tl = cal.dense_calendar(roles.customers(spark, SF_SMALL),
                            roles.monthly_repayments(spark, SF_SMALL), hours=None)
    pv = cal.pivot_calendar(tl)
    from pyspark.sql import functions as F
    total_tl = tl.agg(F.sum(F.rint("AmountTotal"))).first()[0]
    total_pv = pv.agg(sum(F.sum(f"{m}_Total") for m in cal.month_periods.__globals__["MONTH_NAMES"])).first()[0]
    assert total_tl == total_pv   # every cell is rounded half to even
    assert pv.count() == roles.customers(spark, SF_SMALL).count()


def test_null_keys_never_match_but_entities_keep_their_rows(spark):
    ents = spark.createDataFrame([(None,), (1,)], "CustomerID int")
    facts = _facts(spark, [(None, dt.datetime(2024, 1, 1, 9), 5, "UTC"),
                           (1, dt.datetime(2024, 1, 1, 9), 7, "UTC")])
    out = rows(cal.dense_calendar(ents, facts, sort=True))
    assert len(out) == 24
    jan = sorted([r for r in out if r[1] == "January"], key=repr)
    assert jan == [(1, "January", 1, 7.0), (None, "January", 0, 0.0)]


def test_pivot_methods_agree(spark):
    tl = spark.createDataFrame([(1, "January", 1, 0.5), (1, "February", 2, 1.5),
                                (2, "March", 1, 2.5), (2, "March", 1, 3.5)],
                               "CustomerID int, MonthName string, NumberOfRepayments long, "
                               "AmountTotal double")
    a = cal.pivot_calendar(tl)
    b = cal.pivot_calendar(tl, method="pivot")
    assert a.schema == b.schema and rows(a) == rows(b)


def test_months_table_as_spine(spark):
    from ledgerline.functions.time import month_periods
    months = spark.createDataFrame(month_periods(), "MonthID int, MonthName string")
    ents = spark.createDataFrame([(1,)], "CustomerID int")
    facts = _facts(spark, [(1, dt.datetime(2024, 3, 1, 9), 5, "UTC")])
    assert sorted(rows(cal.dense_calendar(ents, facts, months))) == sorted(rows(cal.dense_calendar(ents, facts)))


def test_pivot_cell_beyond_integer_range(spark):
    tl = spark.createDataFrame([(1, "January", 2, 3.0e9)],
                               "CustomerID int, MonthName string, NumberOfRepayments bigint, AmountTotal double")
    for method in ("conditional", "pivot"):
        got = cal.pivot_calendar(tl, method=method).select("January_Repayments", "January_Total").first()
        assert tuple(got) == (2, 3_000_000_000)


def test_period_table_of_any_length(spark):
    ents = spark.createDataFrame([(1,), (2,), (2,)], "CustomerID int")
    facts = spark.createDataFrame([(1, "2023-01-05 10:00:00", 5), (1, "2023-01-05 11:00:00", None), (2, "2023-03-01 10:00:00", 7)],
                                  "CustomerID int, RepaymentDate string, Amount int").selectExpr(
        "CustomerID", "cast(RepaymentDate AS timestamp) AS RepaymentDate", "Amount")
    spine = spark.range(1, 1501).selectExpr("cast(id AS int) AS id", "cast(id AS string) AS name")
    got = rows(cal.dense_calendar(ents, facts, spine))
    assert len(got) == 3 * 1500
    assert [r for r in got if r[2]] == [r for r in got if r[1] in ("1", "3") and (r[0], r[1]) in ((1, "1"), (2, "3"))]
    assert sorted(r for r in got if r[2]) == [(1, "1", 2, 5.0), (2, "3", 1, 7.0), (2, "3", 1, 7.0)]
