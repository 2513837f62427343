"""Role views: the reference's lending tables, derived from the driver's
parquet tables so that every query's work grows with them.

| role       | from                       | mapping                                        |
| ---------- | -------------------------- | ---------------------------------------------- |
| customers  | customer + nation + region | id, name, nation as surname, segment as gender,|
|            |                            | floor(balance) as income, region name          |
| loans      | orders                     | customer, floor(price), 12 x priority digit as |
|            |                            | term, a rate from the order key, status text   |
| credit     | part                       | key, size as score, type as class              |
| repayments | events (by hour) / orders  | user or customer, timestamp, floor(amount)     |
| scheduled  | events                     | one 24-month loan per run of 24 user events    |
| actual     | events                     | the month's repayment, from the event value    |

The data is not clean, as lending extracts aren't; every fault follows from a key, so
that the equivalent SQL has the same rows.  ``raw_customers`` and ``raw_loans`` hold text as
it was typed in (padded, unparsable, decimal, missing, provinces in many spellings) and some
customers twice; loans lack statuses, repayments lack amounts and zones and carry zone
abbreviations, single months lack a payment, and some scheduled loans have no payments at all.

Only ``nation`` (25 rows) and ``region`` (5 rows) are broadcast: their size is
fixed by the TPC-H specification at every scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import half_even
from ledgerline.operators.positions import position
from ledgerline.sources.schemas import SOURCE_SCHEMAS

# --- fixed values of the role mapping ---------------------------------------
MONTHLY_RATE = 0.1 / 12          # 10 % a year, paid monthly (reference model)
TERM_MONTHS = 24                 # every loan runs two years
LOAN_CHUNK = 65536               # loans generated per row when expanding a user
LOAN_SHIFT = 4294967296          # LoanID = user_id * 2^32 + loan number of the user
STATUS_MAP = {"F": "Approved", "O": "Rejected", "P": " rejected"}
PROVINCES_AS_TYPED = [" lp ", "Limpopo", "mp", "Mpumalanga", "Gauteng ", "gt", "KwaZulu Natal", "kzn", "NW",
                      "north west", "EC", " Eastern Cape", "wc", "Western cape", "NC ", "fs", "GP",
                      "EASTERNCAPE", None]            # by CustomerID % 20; the last one keeps its region
ZONES_AS_TYPED = ["UTC", "EST", " ist ", "SAST", "cet", "BST", None]   # by CustomerID % 7
NO_AMOUNT, NO_STATUS, NO_PAYMENT = 53, 19, 4999    # every so many rows by key
UNPAID_USERS = 10                # every so many users hold one loan more that was never paid
ZONES = ["America/New_York", "Asia/Kolkata", "UTC"]   # by user_id % 3
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of ``sf_dir``, read with its declared schema."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    age = F.when(key % 50 == 0, F.lit(None).cast("int")).otherwise(
        (F.lit(15) + (key * 7) % 60).cast("int"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(key.alias("CustomerID"), F.col("c_name").alias("Name"),
                     F.col("n_name").alias("Surname"), age.alias("Age"),
                     F.col("c_mktsegment").alias("Gender"),
                     F.floor("c_acctbal").cast("int").alias("Income"),
                     F.col("r_name").alias("Region")))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as typed in: text incomes, province spellings, missing genders, and every
    37th customer twice under slightly different names."""
    key, income = F.col("CustomerID"), F.col("Income").cast("string")
    form = key % 11
    typed = (F.when(form == 1, F.concat(F.lit("  "), income, F.lit(" "))).when(form == 2, F.lit("n/a"))
             .when(form == 3, F.concat(income, F.lit(".5"))).when(form != 0, income))
    spelt = F.when(key % 20 == len(PROVINCES_AS_TYPED), F.col("Region"))
    for i, name in enumerate(PROVINCES_AS_TYPED):
        spelt = spelt.when(key % 20 == i, F.lit(name).cast("string"))
    name = F.explode(F.when(key % 37 == 0, F.array("Name", F.concat("Name", F.lit(" (copy)"))))
                     .otherwise(F.array("Name")))
    return customers(spark, sf_dir).select(
        key, name.alias("Name"), "Surname", "Age", F.when(key % 29 != 0, F.col("Gender")).alias("Gender"),
        typed.alias("Income"), spelt.alias("Region"))


def _loan_columns() -> tuple:
    """(amount, term, rate, status) of an order; some have no status."""
    status = F.col("o_orderstatus")
    mapped = None
    for k, v in STATUS_MAP.items():
        mapped = (F.when(status == k, F.lit(v)) if mapped is None
                  else mapped.when(status == k, F.lit(v)))
    mapped = mapped.otherwise(status)
    rate = ((F.lit(400) + (F.col("o_orderkey") * 37) % 451).cast("double")
            / F.lit(100.0)).cast("float")
    return (F.floor("o_totalprice").cast("int"),
            F.lit(12) * F.substring("o_orderpriority", 1, 1).try_cast("int"), rate,
            F.when(F.col("o_orderkey") % NO_STATUS != 0, mapped))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, term, rate, status = _loan_columns()
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("CustomerID"), amount.alias("LoanAmount"), term.alias("LoanTerm"),
        rate.alias("InterestRate"), status.alias("ApprovalStatus"))


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as typed in: amounts and terms are text."""
    amount, term, rate, status = _loan_columns()
    amount, term, key = amount.cast("string"), term.cast("string"), F.col("o_orderkey")
    amounts, terms = key % 17, key % 13
    amount = (F.when(amounts == 1, F.concat(F.lit(" "), amount, F.lit(" "))).when(amounts == 2, F.concat(F.lit("R"), amount))
              .when(amounts == 3, F.concat(amount, F.lit(".25"))).when(amounts != 0, amount))
    term = (F.when(terms == 0, F.concat(term, F.lit(".5"))).when(terms == 1, F.concat(F.lit(" "), term, F.lit("  ")))
            .when(terms == 2, F.lit("long")).when(terms == 3, F.concat(term, F.lit(".4"))).otherwise(term))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("CustomerID"), amount.alias("LoanAmount"), term.alias("LoanTerm"),
        rate.alias("InterestRate"), status.alias("ApprovalStatus"))


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("CustomerID"), F.col("p_size").alias("CreditScore"),
        F.col("p_type").alias("CustomerClass"))


def _zone(user) -> F.Column:
    z = None
    for i, name in enumerate(ZONES):
        cond = user % len(ZONES) == i
        z = F.when(cond, F.lit(name)) if z is None else z.when(cond, F.lit(name))
    return z


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments with wall-clock times and a zone per customer (events)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("RepaymentID"), F.col("ts").alias("RepaymentDate"),
        F.when(F.col("event_id") % NO_AMOUNT != 0, F.floor("value").cast("int")).alias("Amount"),
        F.col("user_id").alias("CustomerID"),
        _zone(F.col("user_id")).alias("TimeZone"))


def monthly_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments spread over calendar months, years and hours (orders), with half units,
    missing amounts, and zones as typed in: abbreviations, padding, none."""
    o = table(spark, sf_dir, "orders")
    key, user = F.col("o_orderkey"), F.col("o_custkey")
    # from 04:00 on, so that no time falls into an hour that a clock change skips or repeats
    when = (F.col("o_orderdate").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), (F.lit(4) + key % 20).cast("int")))
    amount = F.floor("o_totalprice").cast("double") + F.when(key % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return o.select(
        key.alias("RepaymentID"), when.alias("RepaymentDate"),
        F.when(key % NO_AMOUNT != 0, amount).alias("Amount"), user.alias("CustomerID"), _typed_zone(user).alias("TimeZone"))


def night_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments in the first four hours of the day (orders), so that some fall into hours that a
    clock change skips or repeats; zones as typed in."""
    o = table(spark, sf_dir, "orders")
    key, user = F.col("o_orderkey"), F.col("o_custkey")
    when = (F.col("o_orderdate").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), (key % 4).cast("int"), (key % 60).cast("int")))
    return o.select(key.alias("RepaymentID"), when.alias("RepaymentDate"), user.alias("CustomerID"), _typed_zone(user).alias("TimeZone"))


def _typed_zone(user) -> F.Column:
    zone = F.lit(None).cast("string")
    for i, name in enumerate(ZONES_AS_TYPED):
        zone = F.when(user % len(ZONES_AS_TYPED) == i, F.lit(name).cast("string")).otherwise(zone)
    return zone


def _annuity(amount) -> F.Column:
    r = F.lit(MONTHLY_RATE)
    factor = r / (F.lit(1.0) - F.pow(F.lit(1.0) + r, F.lit(-float(TERM_MONTHS))))
    return half_even(amount * factor, 2)


def _loan_terms(loan_id, user, block) -> list:
    amount = F.lit(500.0) + ((user * 37 + block * 11) % 50).cast("double") * F.lit(40.0)
    return [loan_id.alias("LoanID"), amount.alias("LoanAmount"),
            _annuity(amount).alias("ScheduledRepayment")]


def loan_months(spark: SparkSession, sf_dir: str, method: str = "scan") -> DataFrame:
    """Each user's events in (ts, event_id) order, cut into consecutive
    24-month loans: LoanID, Month (1..24), ActualRepayment.  Every event is
    used; a loan has at most 24 rows however many events one user has, so
    per-loan state stays bounded.  The numbering is
    :func:`~ledgerline.operators.positions.position`, a range-partitioned scan
    that a hot user does not unbalance."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    pos = position(e, ["user_id"], ["ts", "event_id"], pos_col="pos", method=method)
    user = F.col("user_id")
    block = F.floor((F.col("pos") - 1) / TERM_MONTHS)
    month = ((F.col("pos") - 1) % TERM_MONTHS + 1).cast("int")
    df = pos.select(*_loan_terms(user * F.lit(LOAN_SHIFT) + block, user, block),
                    month.alias("Month"), "value", "event_id")
    sched, v = F.col("ScheduledRepayment"), F.col("value")
    actual = (F.when(F.col("event_id") % NO_PAYMENT == 0, F.lit(None).cast("double"))
               .when(v < 3, F.lit(0.0))
               .when((v < 6) & (F.col("LoanID") % 3 == 0), half_even(sched * 0.5, 2))
               .when(v > 300, half_even(sched * 1.5, 2))
               .otherwise(sched))
    return df.select("LoanID", "Month", actual.alias("ActualRepayment"))


def scheduled_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per loan (LoanID, LoanAmount, ScheduledRepayment): a user with
    n events holds ceil(n / 24) loans, every tenth user one more without payments.  Needs only a per-user count (a
    partial/final aggregate), not the event numbering.

    The loans are generated in two steps -- chunks of ``LOAN_CHUNK`` loan
    numbers, redistributed by (user, chunk), then expanded -- so a user with a
    large share of the events never becomes one huge array in one task."""
    e = table(spark, sf_dir, "events")
    counts = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    last = (F.floor((F.col("_n") - 1) / TERM_MONTHS)            # last loan number of the user
            + F.when(F.col("user_id") % UNPAID_USERS == 0, F.lit(1)).otherwise(F.lit(0)))
    chunks = (counts.select("user_id", last.alias("_last"), F.explode(F.sequence(
                  F.lit(0).cast("bigint"), F.floor(last / LOAN_CHUNK))).alias("_c"))
              .repartition("user_id", "_c"))
    first = F.col("_c") * LOAN_CHUNK
    blocks = chunks.select("user_id", F.explode(F.sequence(
        first, F.least(first + (LOAN_CHUNK - 1), F.col("_last")))).alias("_b"))
    user, block = F.col("user_id"), F.col("_b")
    return blocks.select(*_loan_terms(user * F.lit(LOAN_SHIFT) + block, user, block))


def scheduled_and_actual(spark: SparkSession, sf_dir: str, method: str = "scan",
                         ) -> tuple[DataFrame, DataFrame]:
    """The two inputs of the loan model: scheduled (one row per loan) and
    actual (one row per loan-month)."""
    return scheduled_loans(spark, sf_dir), loan_months(spark, sf_dir, method)


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Register the role views as temporary views (``customers``, ``loans``,
    ``credit``, ``repayments``, ``monthly_repayments``, ``months``,
    ``scheduled``, ``actual``) so the lending questions can also be asked in
    SQL through ``spark.sql``.  Views are lazy -- only the loan numbering
    is written at registration.  Returns the registered names."""
    from ledgerline.functions.time import month_periods

    scheduled, actual = scheduled_and_actual(spark, sf_dir)
    views = {
        "customers": customers(spark, sf_dir), "loans": loans(spark, sf_dir),
        "credit": credit(spark, sf_dir), "repayments": repayments(spark, sf_dir),
        "monthly_repayments": monthly_repayments(spark, sf_dir),
        "months": spark.createDataFrame(month_periods(), "MonthID int, MonthName string"),
        "scheduled": scheduled, "actual": actual,
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
