import pytest

from conftest import rows, sample_csv
from ledgerline.operators import summaries as sm
from ledgerline.sources import read_csv_strict


@pytest.fixture(scope="module")
def sample_loans(spark):
    return read_csv_strict(spark, sample_csv("loans"), "loans")


@pytest.fixture(scope="module")
def sample_credit(spark):
    return read_csv_strict(spark, sample_csv("credit"), "credit")


def test_duplicate_rows_null_keys_never_match(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")],
                               "k int, v string")
    assert sorted(rows(sm.duplicate_rows(df, ["k"]))) == [(1, "a"), (1, "b")]


def test_dedup_then_filter(spark):
    df = spark.createDataFrame(
        [(1, "Ann", "S", "Male", 10), (1, "Bea", "S", "Female", 20), (2, "Cy", "T", "Female", 5)],
        "CustomerID int, Name string, Surname string, Gender string, Income int")
    assert rows(sm.filtered_ranking(df, "Female")) == [("Cy", "T", 5)]


def test_dedup_first_is_idempotent(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9), (2, None)], "k int, v int")
    once = sm.dedup_first(df, ["k"], ["v"])
    assert sorted(rows(once)) == [(1, 2), (2, 9)]
    assert sorted(rows(sm.dedup_first(once, ["k"], ["v"]))) == sorted(rows(once))


def test_conditional_update_inclusive_bounds(spark):
    df = spark.createDataFrame([(1, 599, "B"), (2, 600, "B"), (3, 650, "B"), (4, 651, "B"),
                                (5, None, "B")], "CustomerID int, CreditScore int, CustomerClass string")
    assert rows(sm.conditional_update(df)) == [("B", 3), ("C", 2)]


def test_wide_extract_fans_out_and_keeps_unmatched(spark):
    cust = spark.createDataFrame([(1, 100), (1, 100), (2, 50)], "CustomerID int, Income int")
    cred = spark.createDataFrame([(1, 700), (1, 700)], "CustomerID int, CreditScore int")
    loans = spark.createDataFrame([(1, 10, 12, 4.88, " Approved "), (1, 10, 12, 4.88, "Approved")],
                                  "CustomerID int, LoanAmount int, LoanTerm int, "
                                  "InterestRate float, ApprovalStatus string")
    out = sm.wide_extract(cust, cred, loans)
    got = rows(out)
    assert len([r for r in got if r[0] == 1]) == 8
    assert [r for r in got if r[0] == 2] == [(2, 50.0, None, None, None, None, None)]
    assert {r[4] for r in got if r[0] == 1} == {4.88}
    assert {r[5] for r in got if r[0] == 1} == {"Approved"}


def test_sample_loans_duplicates(sample_loans, sample_credit):
    assert sm.duplicate_rows(sample_loans, ["CustomerID"]).count() == 28
    assert sm.duplicate_rows(sample_credit, ["CustomerID"]).count() == 28


def test_sample_approval_rates(sample_loans):
    got = rows(sm.conditional_rate(sample_loans))
    assert got == [(12, 199, 96, 48.24), (24, 204, 97, 47.55), (36, 186, 85, 45.7),
                   (48, 221, 118, 53.39), (60, 204, 95, 46.57)]
    dedup = rows(sm.conditional_rate(sample_loans, dedup_key="CustomerID"), "LoanTerm", "TotalLoans",
                 "ApprovedLoans")
    assert dedup == [(12, 197, 95), (24, 201, 96), (36, 184, 83), (48, 217, 116), (60, 201, 92)]


def test_sample_class_counts(sample_credit):
    assert rows(sm.category_counts(sample_credit)) == [("B", 521), ("A", 487), ("A+", 6)]
    assert rows(sm.conditional_update(sample_credit)) == [("A", 487), ("C", 275), ("B", 246), ("A+", 6)]


def test_sample_join_mean(sample_loans, sample_credit):
    joined = sample_loans.join(sample_credit, "CustomerID")
    assert joined.count() == 1042
    means = dict(rows(sm.joined_group_mean(sample_credit, sample_loans, value="LoanAmount")))
    assert means["A"] == pytest.approx(19105.30139720559, rel=1e-12)
    assert means["A+"] == 16267.5
    assert means["B"] == pytest.approx(19122.78504672897, rel=1e-12)


def test_normalised_counts_unknown_spelling_passes_through(spark):
    cust = spark.createDataFrame([(1, " kzn "), (2, "KwaZulu Natal"), (3, "GP"), (4, None)],
                                 "CustomerID int, Region string")
    loans = spark.createDataFrame([(1, "rejected "), (2, "REJECTED"), (3, "Rejected"),
                                   (4, "Rejected"), (4, "Approved")],
                                  "CustomerID int, ApprovalStatus string")
    got = rows(sm.normalised_counts(cust, loans))
    assert got == [("GP", 1), ("KwaZulu-Natal", 2), (None, 1)]


def test_save_financing_append_and_overwrite(spark):
    cust = spark.createDataFrame([(1, 100)], "CustomerID long, Income int")
    cred = spark.createDataFrame([(1, 700)], "CustomerID long, CreditScore int")
    loans = spark.createDataFrame([(1, 10, 12, 4.5, "Approved")],
                                  "CustomerID long, LoanAmount int, LoanTerm int, "
                                  "InterestRate float, ApprovalStatus string")
    name = "ledgerline_financing_ops"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sm.save_financing(cust, cred, loans, name, mode="append")
    assert sm.save_financing(cust, cred, loans, name, mode="append").count() == 2
    assert sm.save_financing(cust, cred, loans, name).count() == 1
    assert rows(spark.table(name)) == [(1, 100.0, 10.0, 12, 4.5, "Approved", 700)]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
