"""Properties: layout independence and brute-force agreement."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL, rows
from ledgerline.operators import calendar as cal
from ledgerline.operators import loans as ln
from ledgerline.operators import ranking as rk
from ledgerline.operators import summaries as sm
from ledgerline.sources import roles


def _same(a, b):
    assert sorted(rows(a), key=repr) == sorted(rows(b), key=repr)


def test_results_do_not_depend_on_input_layout(spark):
    cust = roles.customers(spark, SF_SMALL)
    loans = roles.loans(spark, SF_SMALL)
    credit = roles.credit(spark, SF_SMALL)
    reps = roles.repayments(spark, SF_SMALL)
    shuffled = {n: df.repartition(13) for n, df in
                dict(cust=cust, loans=loans, credit=credit, reps=reps).items()}
    _same(sm.conditional_rate(loans), sm.conditional_rate(shuffled["loans"]))
    _same(sm.normalised_counts(cust, loans),
          sm.normalised_counts(shuffled["cust"], shuffled["loans"]))
    _same(sm.wide_extract(cust, credit, loans),
          sm.wide_extract(shuffled["cust"], shuffled["credit"], shuffled["loans"]))
    _same(cal.dense_calendar(cust, reps), cal.dense_calendar(shuffled["cust"], shuffled["reps"]))
    _same(rk.cyclic_shift(cust, method="scan"), rk.cyclic_shift(shuffled["cust"], method="scan"))
    corrected = rk.cyclic_shift(cust)
    _same(rk.rank_in_category(corrected, reps, method="scan"),
          rk.rank_in_category(corrected.repartition(7), shuffled["reps"], method="scan"))
    sched, act = roles.scheduled_and_actual(spark, SF_SMALL)
    _same(ln.loan_balances(sched, act), ln.loan_balances(sched.repartition(5), act.repartition(9)))


def _brute_shift(data, k):
    out = {}
    for g in {d[2] for d in data if d[2] is not None}:
        grp = sorted([d for d in data if d[2] == g], key=lambda d: d[0])
        n = len(grp)
        for i, d in enumerate(grp):
            out[d[0]] = grp[(i + k) % n][1]
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90), st.sampled_from(["A", "B", "C", None])),
                min_size=1, max_size=40),
       st.integers(-5, 5))
def test_cyclic_shift_matches_brute_force(spark, data, k):
    rowsd = [(i, age, g) for i, (age, g) in enumerate(data)]
    df = spark.createDataFrame(rowsd, "CustomerID int, Age int, Gender string")
    want = _brute_shift(rowsd, k)
    for method in ("scan", "window"):
        got = {r[0]: r[2] for r in rows(rk.cyclic_shift(df, k=k, method=method))}
        assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 80), st.integers(0, 5)), min_size=1, max_size=40))
def test_dense_rank_matches_brute_force(spark, data):
    corrected = spark.createDataFrame([(i, a, a, "F") for i, (a, _) in enumerate(data)],
                                      "CustomerID int, Age int, CorrectedAge int, Gender string")
    reps = spark.createDataFrame([(i, amt) for i, (_, amt) in enumerate(data) if amt > 0],
                                 "CustomerID int, Amount int")
    from ledgerline.functions.categories import AGE_BUCKETS

    def cat(a):
        for lo, hi, label in AGE_BUCKETS:
            if (lo is None or a >= lo) and (hi is None or a < hi):
                return label
    tot = {i: amt for i, (_, amt) in enumerate(data)}
    want = {}
    for i, (a, _) in enumerate(data):
        distinct = sorted({tot[j] for j, (b, _) in enumerate(data) if cat(b) == cat(a)}, reverse=True)
        want[i] = distinct.index(tot[i]) + 1
    for method in ("scan", "window"):
        got = {r[0]: r[1] for r in rows(rk.rank_in_category(corrected, reps, method=method),
                                        "CustomerID", "Rank")}
        assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(1, 12), st.integers(0, 23),
                          st.one_of(st.none(), st.integers(0, 500))), max_size=40),
       st.lists(st.sampled_from([1, 2, 4, None]), min_size=1, max_size=5))
def test_dense_calendar_matches_brute_force(spark, facts, entities):
    import datetime as dt
    from ledgerline.functions.time import MONTH_NAMES
    ents = spark.createDataFrame([(e,) for e in entities], "CustomerID int")
    fdf = spark.createDataFrame(
        [(k, dt.datetime(2023, m, 1, h, 30), a, "UTC") for k, m, h, a in facts],
        "CustomerID int, RepaymentDate timestamp_ntz, Amount int, TimeZone string")
    got = sorted(rows(cal.dense_calendar(ents, fdf)), key=repr)
    want = []
    for e in entities:
        for m, name in enumerate(MONTH_NAMES, 1):
            hits = [a for k, mm, h, a in facts if e is not None and k == e and mm == m and 6 <= h <= 18]
            want.append((e, name, len(hits), float(sum(a for a in hits if a is not None))))
    assert got == sorted(want, key=repr)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.floats(100, 5000, allow_nan=False),
                          st.lists(st.one_of(st.none(), st.floats(0, 800, allow_nan=False)),
                                   min_size=1, max_size=8)),
                min_size=1, max_size=4, unique_by=lambda t: t[0]))
def test_balance_fold_matches_sequential_loop(spark, loans):
    import numpy as np
    r = ln.MONTHLY_RATE
    sched = spark.createDataFrame([(lid, amt, 1.0) for lid, amt, _ in loans],
                                  "LoanID long, LoanAmount double, ScheduledRepayment double")
    act = spark.createDataFrame([(lid, m, p) for lid, _, pays in loans for m, p in enumerate(pays, 1)],
                                "LoanID long, Month int, ActualRepayment double")
    got = {(x[0], x[1]): x[2:] for x in rows(ln.loan_balances(sched, act, method="fold"),
                                             "LoanID", "Month", "LoanBalanceStart",
                                             "LoanBalanceEnd", "InterestPayment")}
    for lid, amt, pays in loans:
        b = None
        for m, p in enumerate(pays, 1):
            start = amt if b is None else b
            interest = start * r
            new = (start + interest) - (float("nan") if p is None else p)
            b = new if new > 0 else 0.0          # max(0, NaN) is 0 in the pandas model
            want = tuple(float(np.round(v, 2)) for v in (start, b, interest))
            assert got[(lid, m)] == want
