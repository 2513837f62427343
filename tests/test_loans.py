import random

import pytest
from pyspark.sql import functions as F

from conftest import rows, sample_csv
from ledgerline.operators import loans as ln
from ledgerline.sources import read_csv_inferred

R = 0.1 / 12


def _loop(amount, pays):
    """Sequential roll-forward written from the model's definition."""
    out, b = [], None
    for p in pays:
        start = amount if b is None else b
        interest = start * R
        new = (start + interest) - p
        b = new if new > 0 else 0.0
        out.append((start, b, interest))
    return out


def _frames(spark, loans):
    sched = spark.createDataFrame([(lid, amt, s) for lid, amt, s, _ in loans],
                                  "LoanID long, LoanAmount double, ScheduledRepayment double")
    act = spark.createDataFrame([(lid, m, p) for lid, _, _, pays in loans
                                 for m, p in enumerate(pays, 1)],
                                "LoanID long, Month int, ActualRepayment double")
    return sched, act


@pytest.mark.parametrize("method", ["fold", "closed_form"])
def test_balance_fixture(spark, method):
    sched, act = _frames(spark, [(1, 1200.0, 100.0, [700.0, 600.0, 100.0])])
    out = rows(ln.loan_balances(sched, act, method=method).orderBy("Month"),
               "LoanBalanceStart", "InterestPayment", "LoanBalanceEnd")
    assert out == [(1200.0, 10.0, 510.0), (510.0, 4.25, 0.0), (0.0, 0.0, 0.0)]


def test_fold_is_bit_identical_to_loop_and_closed_form_close(spark):
    rnd = random.Random(11)
    loans = []
    for lid in range(40):
        amt = float(rnd.randint(5, 120) * 1000)
        sched = round(amt * R / (1 - (1 + R) ** -24), 2)
        pays = [rnd.choice([0.0, sched, round(sched * 0.5, 2), round(sched * 1.7, 2)])
                for _ in range(24)]
        loans.append((lid, amt, sched, pays))
    sched, act = _frames(spark, loans)
    fold = {(r[0], r[1]): r[2:] for r in rows(ln.loan_balances(sched, act).repartition(5),
                                                "LoanID", "Month", "LoanBalanceStart",
                                                "LoanBalanceEnd", "InterestPayment")}
    closed = {(r[0], r[1]): r[2:] for r in rows(ln.loan_balances(sched, act, method="closed_form"),
                                                  "LoanID", "Month", "LoanBalanceStart",
                                                  "LoanBalanceEnd", "InterestPayment")}
    import numpy as np
    for lid, amt, _, pays in loans:
        for m, (s, e, i) in enumerate(_loop(amt, pays), 1):
            want = tuple(float(np.round(x, 2)) for x in (s, e, i))
            assert fold[(lid, m)] == want
            assert all(abs(a - b) <= 0.011 for a, b in zip(closed[(lid, m)], want))


def test_missing_payment_zeroes_balance(spark):
    sched = spark.createDataFrame([(1, 1000.0, 50.0)], "LoanID long, LoanAmount double, ScheduledRepayment double")
    act = spark.createDataFrame([(1, 1, None), (1, 2, 50.0)], "LoanID long, Month int, ActualRepayment double")
    out = rows(ln.loan_balances(sched, act).orderBy("Month"), "LoanBalanceEnd")
    assert out == [(0.0,), (0.0,)]


def _bal(spark, data):
    return spark.createDataFrame(data, "LoanID long, Month int, ActualRepayment double, "
                                       "ScheduledRepayment double, LoanBalanceStart double, "
                                       "LoanBalanceEnd double, InterestPayment double")


def test_type1(spark):
    b = _bal(spark, [(1, 1, 100.0, 100.0, 1.0, 1.0, 0.0), (1, 2, 100.0, 100.0, 1.0, 1.0, 0.0),
                     (2, 1, 100.0, 100.0, 1.0, 1.0, 0.0), (2, 2, 99.0, 100.0, 1.0, 1.0, 0.0),
                     (3, 1, None, 100.0, 1.0, 1.0, 0.0), (3, 2, 100.0, 100.0, 1.0, 1.0, 0.0),
                     (4, 1, 100.0, 100.0, 1.0, 1.0, 0.0)])
    assert ln.type1_default_rate(b).first()[0] == 25.0


def test_type2_scheduled_only_loan_in_denominator(spark):
    sched = spark.createDataFrame([(1, 2400.0, 100.0), (2, 2400.0, 100.0)],
                                  "LoanID long, LoanAmount double, ScheduledRepayment double")
    b = _bal(spark, [(1, m, 100.0, 100.0, 1.0, 1.0, 0.0) for m in range(1, 11)])
    assert ln.type2_default_rate(sched, b).first()[0] == 50.0
    assert ln.type2_default_rate(sched, b, max_month=12).first()[0] == 50.0


def test_cpr_empty_and_expected_loss_without_month_13(spark):
    b = _bal(spark, [(1, 1, 100.0, 100.0, 0.0, 0.0, 0.0)])
    assert ln.prepayment_cpr(b).first()[0] == 0.0
    assert ln.expected_loss(b).first()[0] == 0.0


def test_cpr_matches_product_formula(spark):
    rnd = random.Random(5)
    data = []
    for lid in range(30):
        for m in range(1, 14):
            start = rnd.uniform(0, 1000)
            end = max(0.0, start - rnd.uniform(0, 300))
            data.append((lid, m, 50.0, 60.0, round(start, 2), round(end, 2), round(start * R, 2)))
    b = _bal(spark, data)
    import numpy as np
    smm = []
    sp = []
    for _, _, _, s, st, en, it in data:
        sp.append(s - it)
        if st > 0:
            smm.append(max(0.0, (st - en) - (s - it)) / st)
    mean = np.prod([1 + x for x in smm]) ** (1 / 12) - 1
    want = (1 - (1 - mean) ** 12) * 100
    assert ln.prepayment_cpr(b).first()[0] == pytest.approx(want, rel=1e-12)
    med = float(np.median(sp))
    smm2 = [min(max(max(0.0, (st - en) - med) / st, 0), 1) for _, _, _, s, st, en, it in data if st > 0]
    mean2 = np.prod([1 + x for x in smm2]) ** (1 / 12) - 1
    want2 = (1 - (1 - mean2) ** 12) * 100
    assert ln.prepayment_cpr(b, variant="median").first()[0] == pytest.approx(want2, rel=1e-12)


def test_expected_loss(spark):
    rows_ = []
    for lid, pay in [(1, 100.0), (2, 50.0)]:
        for m in range(1, 14):
            rows_.append((lid, m, pay, 100.0, 1000.0 if m == 13 else 1.0, 1.0, 0.0))
    b = _bal(spark, rows_)
    assert ln.expected_loss(b).first()[0] == pytest.approx(0.5 * 2000.0 * (1 - 0.8), rel=1e-15)


def test_natural_join_needs_a_common_column(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1,)], "y int")
    with pytest.raises(ValueError):
        ln.natural_join(a, b)


def test_sample_scheduled_file(spark):
    df = read_csv_inferred(spark, sample_csv("scheduled"))
    got = df.agg(F.count(F.lit(1)), F.sum("LoanAmount"), F.round(F.sum("ScheduledRepayment"), 2)).first()
    assert tuple(got) == (1000, 64950000.0, 2997112.72)


def _sequential(amount, months, rate=ln.MONTHLY_RATE):
    """Balances by a plain loop; months in order, a missing payment ends at 0."""
    out, b = [], float(amount)
    for _, paid in sorted(months, key=lambda m: (m[0] is None, m[0] or 0, m[1] is None, m[1] or 0)):
        interest = b * rate
        new = b + interest - paid if paid is not None else 0.0
        end = max(0.0, new)
        out.append((round(b, 2), round(end, 2)))
        b = end
    return out


@pytest.mark.parametrize("months", [
    [(1, 100.0), (2, None), (3, 50.0)], [(1, None), (2, 100.0)], [(1, 100.0), (None, 50.0)],
    [(2, 10.0), (2, None), (1, 30.0)]])
def test_fold_matches_a_loop_with_missing_values(spark, months):
    sched = spark.createDataFrame([(1, 1000.0, 100.0)], "LoanID long, LoanAmount double, ScheduledRepayment double")
    act = spark.createDataFrame([(1, m, p) for m, p in months], "LoanID long, Month int, ActualRepayment double")
    got = rows(ln.loan_balances(sched, act), "LoanBalanceStart", "LoanBalanceEnd")
    assert got == _sequential(1000, months)


def test_fold_holds_on_a_long_interest_only_loan(spark):
    n = 5000
    interest = 1000.0 * ln.MONTHLY_RATE
    sched = spark.createDataFrame([(1, 1000.0, interest)], "LoanID long, LoanAmount double, ScheduledRepayment double")
    act = spark.range(1, n + 1).select(F.lit(1).cast("long").alias("LoanID"), F.col("id").cast("int").alias("Month"),
                                       F.lit(interest).alias("ActualRepayment"))
    got = rows(ln.loan_balances(sched, act), "LoanBalanceStart", "LoanBalanceEnd")
    assert len(got) == n and got == _sequential(1000, [(m, interest) for m in range(1, n + 1)])
    assert got[-1][1] == pytest.approx(1000.0, abs=0.01)


def test_closed_form_refuses_what_it_cannot_answer(spark):
    sched = spark.createDataFrame([(1, 1000.0, 100.0)], "LoanID long, LoanAmount double, ScheduledRepayment double")
    missing = spark.createDataFrame([(1, 1, None)], "LoanID long, Month int, ActualRepayment double")
    long = spark.range(1, 2500).selectExpr("1L AS LoanID", "cast(id AS int) AS Month", "8.0D AS ActualRepayment")
    for act in (missing, long):
        with pytest.raises(Exception, match="closed form"):
            ln.loan_balances(sched, act, method="closed_form").collect()


def test_portfolio_cpr_is_finite_for_two_million_loan_months(spark):
    months = spark.range(0, 2_000_000).selectExpr(
        "id AS LoanID", "cast(id % 12 + 1 AS int) AS Month", "1000.0D AS LoanBalanceStart", "890.0D AS LoanBalanceEnd",
        "100.0D AS ScheduledRepayment", "8.0D AS InterestPayment")
    smm = (110.0 - 92.0) / 1000.0
    got = ln.prepayment_cpr(months, scope="month").first()[0]
    assert got == pytest.approx((1 - (1 - smm) ** 12) * 100)


def test_extra_columns_survive_the_merge(spark):
    sched = spark.createDataFrame([(1, 1200.0, 100.0, "A")],
                                  "LoanID long, LoanAmount double, ScheduledRepayment double, grade string")
    act = spark.createDataFrame([(1, 1, 700.0, "web")], "LoanID long, Month int, ActualRepayment double, channel string")
    out = ln.loan_balances(sched, act, method="fold")
    assert out.columns == ["LoanID", "Month", "ActualRepayment", "channel", "LoanAmount",
                           "ScheduledRepayment", "grade", "LoanBalanceStart", "LoanBalanceEnd",
                           "InterestPayment"]
    assert rows(out, "channel", "grade", "LoanBalanceEnd") == [("web", "A", 510.0)]


def test_type1_fixture_one_of_two_loans_short(spark):
    b = _bal(spark, [(1, m, 100.0, 100.0, 1.0, 1.0, 0.0) for m in range(1, 4)]
             + [(2, 1, 100.0, 100.0, 1.0, 1.0, 0.0), (2, 2, 60.0, 100.0, 1.0, 1.0, 0.0),
                (2, 3, 100.0, 100.0, 1.0, 1.0, 0.0)])
    assert ln.type1_default_rate(b).first()[0] == 50.0
