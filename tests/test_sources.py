import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows, sample_csv
from ledgerline.sources import (
    SCHEMAS, append_table, create_table_if_absent, load_tables, read_csv_inferred, read_csv_strict,
    replace_table,
    update_where, write_if_absent,
)
from ledgerline.sources import roles
from ledgerline.sources.schemas import FINANCING


def _csv(text):
    d = tempfile.mkdtemp(prefix="ledgerline-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_strict_reader_rejects_bad_value(spark):
    p = _csv("MonthID,MonthName\n1,January\nzz,February\n")
    with pytest.raises(Exception):
        read_csv_strict(spark, p, "months").collect()


def test_strict_reader_rejects_reordered_header(spark):
    p = _csv("MonthName,MonthID\nJanuary,1\n")
    with pytest.raises(Exception):
        read_csv_strict(spark, p, "months").collect()


def test_load_sample_tables(spark):
    paths = {name: sample_csv(name) for name in ("loans", "credit", "months")}
    out = tempfile.mkdtemp(prefix="ledgerline-load-")
    t = load_tables(spark, paths, out)
    assert {k: v.count() for k, v in t.items()} == {"loans": 1014, "credit": 1014, "months": 12}
    for name, df in t.items():
        assert df.schema == SCHEMAS[name]
        nulls = df.select([F.sum(F.col(c).isNull().cast("int")) for c in df.columns]).first()
        assert all(n == 0 for n in nulls)
    assert rows(t["months"].orderBy("MonthID").limit(2)) == [(1, "January"), (2, "February")]


LOANS = ("CustomerID,LoanAmount,LoanTerm,InterestRate,ApprovalStatus\r\n" + "".join(
    f"{i % 30},{1000 + i},{12 * (1 + i % 5)},{4 + i / 16},{'Approved' if i % 3 else ' rejected'}\r\n"
    for i in range(40)) + "\r\n")
CREDIT = "CustomerID,CreditScore,CustomerClass\n" + "".join(f"{i},{500 + 5 * i},A+\n" for i in range(35))


def test_strict_reader_loads_a_good_file(spark):
    """CRLF line ends, a blank last line and repeated ids are all fine."""
    df = read_csv_strict(spark, _csv(LOANS), "loans")
    assert df.schema == SCHEMAS["loans"]
    assert df.count() == 40 and df.select("CustomerID").distinct().count() == 30
    assert df.filter("ApprovalStatus like '%rejected'").count() == 14


def test_inferred_reader(spark):
    df = read_csv_inferred(spark, _csv(CREDIT))
    assert dict(df.dtypes) == {"CustomerID": "int", "CreditScore": "int", "CustomerClass": "string"}
    assert df.count() == 35 and df.agg(F.max("CreditScore")).first()[0] == 670


def test_load_generated_tables(spark):
    paths = {"loans": _csv(LOANS), "credit": _csv(CREDIT)}
    out = tempfile.mkdtemp(prefix="ledgerline-load-")
    for _ in range(2):  # a re-run replaces, it does not append
        t = load_tables(spark, paths, out)
        assert {k: v.count() for k, v in t.items()} == {"loans": 40, "credit": 35}
        for name, df in t.items():
            assert df.schema == SCHEMAS[name]
    assert load_tables(spark, paths)["credit"].count() == 35


def test_table_statements(spark):
    name = "ledgerline_financing_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table_if_absent(spark, name, FINANCING)
    create_table_if_absent(spark, name, FINANCING)          # no-op when present
    src = spark.createDataFrame([(1, 1.0, 2.0, 12, 4.5, "Approved", 700)], FINANCING)
    append_table(src, name)
    append_table(src, name)                                 # INSERT appends on re-run
    assert spark.table(name).count() == 2
    first = write_if_absent(src.limit(0), name + "_t")
    again = write_if_absent(src, name + "_t")                # the first result is kept
    assert first.count() == 0 and again.count() == 0
    assert replace_table(src, name + "_t").count() == 1
    upd = update_where(src, "ApprovalStatus", "X", F.col("CreditScore") > 600)
    assert rows(upd, "ApprovalStatus") == [("X",)]
    for t in (name, name + "_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _unpaid(spark):
    """Loans without payments: one for every so many users."""
    users = roles.table(spark, SF_SMALL, "events").select("user_id").distinct()
    return users.filter(F.col("user_id") % roles.UNPAID_USERS == 0).count()


def test_raw_views_hold_what_was_typed(spark):
    raw = roles.raw_customers(spark, SF_SMALL)
    assert raw.count() > roles.customers(spark, SF_SMALL).count()
    assert raw.select("CustomerID").distinct().count() == roles.customers(spark, SF_SMALL).count()
    for condition in ("Income is null", "Income = 'n/a'", "Income like '  %'", "Income like '%.5'",
                      "Gender is null", "Region is null", "Region = ' lp '"):
        assert raw.filter(condition).count() > 0, condition
    loans = roles.raw_loans(spark, SF_SMALL)
    for condition in ("LoanTerm = 'long'", "LoanTerm like '%.5'", "LoanAmount like 'R%'", "LoanAmount is null",
                      "ApprovalStatus is null"):
        assert loans.filter(condition).count() > 0, condition


def test_role_views_have_lending_shapes(spark):
    c = roles.customers(spark, SF_SMALL)
    assert c.columns == ["CustomerID", "Name", "Surname", "Age", "Gender", "Income", "Region"]
    lo = roles.loans(spark, SF_SMALL)
    assert {r[0] for r in lo.select("LoanTerm").distinct().collect()} <= {12, 24, 36, 48, 60}
    sched, act = roles.scheduled_and_actual(spark, SF_SMALL)
    events = roles.table(spark, SF_SMALL, "events").count()
    assert act.count() == events                                  # every event is used
    assert act.groupBy("LoanID").count().agg(F.max("count")).first()[0] <= 24
    unpaid = _unpaid(spark)
    assert unpaid > 0
    assert sched.count() == act.select("LoanID").distinct().count() + unpaid
    assert sched.join(act, "LoanID", "left_anti").count() == unpaid


def test_scheduled_loans_chunked_expansion(spark, monkeypatch):
    monkeypatch.setattr(roles, "LOAN_CHUNK", 2)
    sched, act = roles.scheduled_and_actual(spark, SF_SMALL)
    ids = act.select("LoanID").distinct()
    assert ids.exceptAll(sched.select("LoanID")).count() == 0
    assert sched.select("LoanID").exceptAll(ids).count() == _unpaid(spark)


def test_register_views_supports_sql(spark):
    names = roles.register_views(spark, SF_SMALL, prefix="ll_")
    assert "ll_customers" in names and "ll_actual" in names
    got = spark.sql("""
        SELECT LoanTerm, count(*) AS n FROM ll_loans WHERE ApprovalStatus IS NOT NULL
        GROUP BY LoanTerm ORDER BY LoanTerm""").collect()
    assert [r.LoanTerm for r in got] == [12, 24, 36, 48, 60]
    assert spark.sql("SELECT count(*) FROM ll_months").first()[0] == 12


def test_saved_derived_tables(spark):
    from ledgerline.operators import calendar as cal
    from ledgerline.operators import ranking as rk
    for t in ("ll_timeline", "ll_corrected"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    cust = roles.customers(spark, SF_SMALL)
    first = cal.save_timeline(cust, roles.monthly_repayments(spark, SF_SMALL), "ll_timeline",
                              hours=None)
    n = first.count()
    # IF NOT EXISTS: a second call with other input keeps the stored table
    again = cal.save_timeline(cust.limit(1), roles.monthly_repayments(spark, SF_SMALL),
                              "ll_timeline", hours=None)
    assert again.count() == n == 12 * cust.count()
    assert cal.pivot_calendar(spark.table("ll_timeline")).count() == cust.count()
    corrected = rk.save_corrected_customers(cust, "ll_corrected")
    assert corrected.columns == ["CustomerID", "Age", "CorrectedAge", "Gender"]
    assert rk.save_corrected_customers(cust.limit(10), "ll_corrected").count() == 10
    for t in ("ll_timeline", "ll_corrected"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_declared_source_schemas_match_files(spark):
    from ledgerline.sources.schemas import SOURCE_SCHEMAS
    for name in SOURCE_SCHEMAS:
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        assert roles.table(spark, SF_SMALL, name).schema == inferred, name


def test_sql_over_views_equals_operator(spark):
    from ledgerline.operators import summaries as sm
    roles.register_views(spark, SF_SMALL, prefix="v_")
    via_sql = spark.sql("""
        SELECT k.CustomerClass, avg(try_cast(trim(cast(c.Income AS STRING)) AS DOUBLE)) AS AverageIncome
        FROM v_credit k JOIN v_customers c ON c.CustomerID = k.CustomerID
        WHERE try_cast(trim(cast(c.Income AS STRING)) AS DOUBLE) IS NOT NULL
        GROUP BY k.CustomerClass""")
    via_op = sm.joined_group_mean(roles.credit(spark, SF_SMALL), roles.customers(spark, SF_SMALL))
    assert sorted(rows(via_sql)) == sorted(rows(via_op))
