"""The unclean rows of the role views reach the arms written for them: with an arm taken out, or
with the rows it is for changed, a registered query no longer equals its oracle."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import casts, time
from ledgerline.operators import calendar as cal
from ledgerline.operators import loans as ln
from ledgerline.operators import summaries as sm
from ledgerline.plans.catalog import ORACLE, QUERIES
from ledgerline.sources import roles
from parity import digest, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    con, known = duck(SF), {}

    def of(name):
        if name not in known:
            res = con.execute(ORACLE[name])
            known[name] = digest([d[0] for d in res.description], res.fetchall())[0]
        return known[name]
    return of


def matches(df, expected) -> bool:
    return digest(df.columns, [tuple(r) for r in df.collect()])[0] == expected


def no_try(c):
    return casts.text(c).cast("double")


ARMS = [  # (what is taken out, query, module, name, what stands in its place)
    ("F19 P12 province spellings", "normalised_counts", sm, "normalise_province", F.trim),
    ("F4 unparsable text is NULL", "joined_group_mean", sm, "try_double", no_try),
    ("F4 unparsable text is NULL", "wide_extract", sm, "try_double", no_try),
    ("F5 decimal text is rounded", "wide_extract", sm, "try_int", lambda c: casts.text(c).try_cast("int")),
    ("F6 totals are rounded to even", "pivot_months", F, "expr", lambda sql, make=F.expr: make(sql.replace("rint", ""))),
    ("F13 zone abbreviations", "timeline_london_hours", time, "ZONE_ALIASES", {"XX": "UTC"}),
    ("C3 copies are dropped", "filtered_ranking", sm, "dedup_first", lambda df, *_, **__: df),
]


@pytest.mark.parametrize(("arm", "name", "module", "attribute", "instead"), ARMS,
                         ids=[f"{a.split()[0]}-{n}" for a, n, *_ in ARMS])
def test_query_needs_the_arm(spark, oracle, monkeypatch, arm, name, module, attribute, instead):
    assert matches(QUERIES[name](spark, SF), oracle(name))
    monkeypatch.setattr(module, attribute, instead)
    try:
        same = matches(QUERIES[name](spark, SF), oracle(name))
    except Exception:  # noqa: BLE001  an error is a difference too
        same = False
    assert not same, arm


def test_missing_status_is_left_out(spark, oracle):
    loans = roles.loans(spark, SF)
    assert matches(sm.conditional_rate(loans), oracle("conditional_rate"))
    assert not matches(sm.conditional_rate(loans.fillna("?", ["ApprovalStatus"])), oracle("conditional_rate"))


def test_copies_weigh_in_the_joined_mean(spark, oracle):
    once = roles.raw_customers(spark, SF).dropDuplicates(["CustomerID"])
    assert not matches(sm.joined_group_mean(roles.credit(spark, SF), once), oracle("joined_group_mean"))


def test_missing_amounts_add_nothing(spark, oracle):
    cust, paid = roles.customers(spark, SF), roles.monthly_repayments(spark, SF)
    assert matches(cal.dense_calendar(cust, paid.fillna(0.0, ["Amount"]), hours=None), oracle("timeline_monthly"))
    assert not matches(cal.dense_calendar(cust, paid.filter("Amount is not null"), hours=None), oracle("timeline_monthly"))


def test_missing_zone_keeps_the_clock(spark, oracle):
    cust, paid = roles.customers(spark, SF), roles.monthly_repayments(spark, SF)
    for zone, same in (("Europe/London", True), ("America/New_York", False)):
        df = cal.dense_calendar(cust, paid.fillna(zone, ["TimeZone"]), hours=(0, 12), zone_col="TimeZone")
        assert matches(df, oracle("timeline_london_hours")) == same


def test_unpaid_loans_stay_in_the_denominator(spark, oracle):
    scheduled, actual = roles.scheduled_and_actual(spark, SF)
    merged = ln.natural_join(actual, scheduled)
    assert matches(ln.type2_default_rate(scheduled, merged), oracle("type2_default_rate"))
    paid = scheduled.join(actual, "LoanID", "left_semi")
    assert not matches(ln.type2_default_rate(paid, merged), oracle("type2_default_rate"))


def test_missing_payment_ends_the_balance(spark, oracle):
    scheduled, actual = roles.scheduled_and_actual(spark, SF)
    assert actual.filter("ActualRepayment is null").count() > 0
    balances = ln.loan_balances(scheduled, actual)
    assert matches(balances, oracle("loan_balances"))
    ended = balances.filter("ActualRepayment is null").select("LoanBalanceEnd").collect()
    assert ended and all(r[0] == 0.0 for r in ended)
