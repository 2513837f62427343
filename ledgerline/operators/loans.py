"""Loan performance model (C16-C22): balance roll-forward, two default
definitions, annualised prepayment (CPR) and expected loss.

Each loan's months are one group.  A loan has one row per month of its term,
so the state a task holds for a loan is bounded by the term, not by the data
volume; the balance recurrence is a fold inside the JVM (``aggregate`` over
the loan's sorted months), with no Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ledgerline.functions.casts import clip, half_even
from ledgerline.operators.exact import exact_sums
from ledgerline.operators.recurrence import running_balance
from ledgerline.operators.selection import exact_median
from ledgerline.session import freeze

MONTHLY_RATE = 0.1 / 12          # fixed value: 10 % a year, compounded monthly
FOLD_BLOCK = 64                  # months that the fold gathers before it sets them aside
CLOSED_FORM_GROWTH = 1e6         # largest (1 + r)^t that the closed form accepts
RECOVERY_RATE = 0.80             # fixed value: expected-loss recovery


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``pd.merge(left, right)``: join on every column name the two share.

    Raises when they share none (Spark's NATURAL JOIN would silently become a
    cross join)."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural join: the two frames share no column")
    return left.join(right, common, how)


_ORDER_FIELDS = ["Month", "ActualRepayment"]     # sort order of a loan's months


def _step_fields(merged: DataFrame, key: str) -> list[str]:
    """Month and payment first (they order the fold), then every other merged
    column, so extra columns of either input survive as with ``pd.merge``."""
    return _ORDER_FIELDS + [c for c in merged.columns if c not in _ORDER_FIELDS and c != key]


def loan_balances(scheduled: DataFrame, actual: DataFrame, rate: float = MONTHLY_RATE,
                  key: str = "LoanID", method: str = "prefix") -> DataFrame:
    """Month-by-month balances of every loan that has actual repayments.

    With B0 = LoanAmount, each month in ``Month`` order (NULLs last): interest = B*r,
    end = max(0, B + interest - paid), start = previous end.  A missing
    payment makes the end balance 0 (``max(0, NaN)`` in the pandas model).
    Start, end and interest are rounded to cents half-to-even *after* the
    whole roll-forward (interest accrues on the unrounded balance).  Ties on
    ``Month`` are broken by the paid amount.

    ``method="prefix"`` (default, at every history length):
    :func:`~ledgerline.operators.recurrence.running_balance`, a parallel prefix over
    range-sorted months; no task holds a loan as a whole.
    ``method="fold"``: ``collect_list`` of the loan's months, sorted, folded with
    ``aggregate`` -- the same floating-point steps as a sequential loop, one row per
    loan; the check of the prefix.  Rows are gathered in blocks of ``FOLD_BLOCK``,
    so a long history is not copied once a month.
    ``method="closed_form"``: running sums and minima over a window
    (Lindley's reflection formula), a check of the fold on short, complete
    histories.  It has another answer for a missing payment and loses digits as
    (1 + r)^t grows, so it raises on NULL or NaN payments and where (1 + r)^t
    exceeds ``CLOSED_FORM_GROWTH``.
    Output: key, Month, ActualRepayment, the other input columns
    (LoanAmount, ScheduledRepayment, ...), LoanBalanceStart, LoanBalanceEnd,
    InterestPayment."""
    merged = natural_join(actual, scheduled)
    if method == "prefix":
        rows = _prefix(merged, rate, key)
    elif method == "fold":
        rows = _fold(merged, rate, key)
    elif method == "closed_form":
        rows = _closed_form(merged, rate, key)
    else:
        raise ValueError(f"unknown method {method!r}")
    return rows.select(
        key, *_step_fields(merged, key),
        half_even(F.col("_start"), 2).alias("LoanBalanceStart"),
        half_even(F.col("_end"), 2).alias("LoanBalanceEnd"),
        half_even(F.col("_int"), 2).alias("InterestPayment"))


def _prefix(merged: DataFrame, rate: float, key: str) -> DataFrame:
    months = merged.select(key, *_step_fields(merged, key)).withColumn("_paid", F.col("ActualRepayment").cast("double"))
    rows = running_balance(months, key, _ORDER_FIELDS, "LoanAmount", "_paid", rate)
    interest = F.col("_start") * F.lit(rate)
    new = (F.col("_start") + interest) - F.col("_paid")
    end = F.when((new > 0) & ~F.isnan(new), new).otherwise(F.lit(0.0))
    return rows.select("*", interest.alias("_int"), end.alias("_end"))


def _bind(value, body):
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _fold(merged: DataFrame, rate: float, key: str) -> DataFrame:
    types = {f.name: f.dataType for f in merged.schema.fields}
    fields = _step_fields(merged, key)
    out_type = ArrayType(StructType(
        [StructField(n, types[n]) for n in fields]
        + [StructField(n, DoubleType()) for n in ("_start", "_end", "_int")]))
    r = F.lit(rate)

    def grow(acc, x, end, interest):
        row = F.array(F.struct(*[x[n].alias(n) for n in fields], acc["b"].alias("_start"),
                               end.alias("_end"), interest.alias("_int")))
        full = F.size(acc["block"]) >= FOLD_BLOCK
        return F.struct(
            end.alias("b"),
            F.when(full, row).otherwise(F.concat(acc["block"], row)).alias("block"),
            F.when(full, F.concat(acc["done"], F.array(acc["block"]))).otherwise(acc["done"]).alias("done"))

    def step(acc, x):
        def paid(interest):
            new = (acc["b"] + interest) - x["ActualRepayment"]
            return _bind(new, lambda n: _bind(F.when((n > 0) & ~F.isnan(n), n).otherwise(F.lit(0.0)),
                                              lambda end: grow(acc, x, end, interest)))
        return _bind(acc["b"] * r, paid)

    # NULLs last: each sort key is led by whether it is missing
    sort_key = [f(F.col(c)) for c in _ORDER_FIELDS for f in (lambda c: c.isNull(), lambda c: c)]
    entry = F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(sort_key)],
                     F.struct(*[F.col(n) for n in fields]).alias("x"))
    per_loan = merged.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_s")).select(
        key, F.transform("_s", lambda e: e["x"]).alias("_xs"))
    init = F.struct(F.col("_xs")[0]["LoanAmount"].cast("double").alias("b"),
                    F.array().cast(out_type).alias("block"),
                    F.array().cast(ArrayType(out_type)).alias("done"))
    folded = per_loan.select(key, F.aggregate(
        "_xs", init, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["block"])).alias("_out"))
    return folded.select(key, F.inline("_out"))


def _closed_form(merged: DataFrame, rate: float, key: str) -> DataFrame:
    g = 1.0 + rate
    w = Window.partitionBy(key).orderBy(F.col("Month").asc_nulls_last(),
                                        F.col("ActualRepayment").asc_nulls_last())
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.col("ActualRepayment").isNull() | F.isnan(F.col("ActualRepayment").cast("double"))
    df = merged.withColumn("_t", F.row_number().over(w))
    df = df.withColumn("_t", F.when(missing, F.raise_error("closed form: missing payment").cast("int"))
                       .when(F.pow(F.lit(g), F.col("_t")) > CLOSED_FORM_GROWTH,
                             F.raise_error("closed form: history too long").cast("int"))
                       .otherwise(F.col("_t")))
    b0 = F.first("LoanAmount").over(w.rowsBetween(Window.unboundedPreceding,
                                                  Window.unboundedFollowing))
    df = df.withColumn("_b0", b0.cast("double"))
    df = df.withColumn("_x", F.col("_b0") - F.sum(
        F.col("ActualRepayment") * F.pow(F.lit(g), -F.col("_t"))).over(run))
    df = df.withColumn("_m", F.least(F.lit(0.0), F.min("_x").over(run)))
    df = df.withColumn("_end", F.pow(F.lit(g), F.col("_t")) * (F.col("_x") - F.col("_m")))
    df = df.withColumn("_start", F.coalesce(F.lag("_end").over(w), F.col("_b0")))
    return df.withColumn("_int", F.col("_start") * F.lit(rate))


def type1_default_rate(balances: DataFrame, key: str = "LoanID",
                       name: str = "type1_default_rate") -> DataFrame:
    """Percent of loans with any month paid below schedule (a missing value is
    not a miss).  One row."""
    missed = F.coalesce(F.col("ActualRepayment") < F.col("ScheduledRepayment"), F.lit(False))
    per_loan = balances.groupBy(key).agg(F.bool_or(missed).alias("_d"))
    return per_loan.agg((F.avg(F.col("_d").cast("int")) * F.lit(100.0)).alias(name))


def _yearly_default(sched_yearly, actual_yearly) -> F.Column:
    unpaid = sched_yearly - actual_yearly
    return F.coalesce(unpaid > F.lit(0.15) * sched_yearly, F.lit(False))


def type2_default_rate(scheduled: DataFrame, balances: DataFrame, key: str = "LoanID",
                       max_month: int | None = None,
                       name: str = "type2_default_rate") -> DataFrame:
    """Percent of loans whose unpaid amount -- 12 scheduled payments minus the
    actual payments -- exceeds 15 % of the 12 scheduled payments.

    Scheduled and actual totals are aligned by a full outer join: a loan on
    one side only has no unpaid amount, so it is not a default, but it stays in
    the denominator.  By default *all* actual months are summed (the
    reference's behaviour); ``max_month=12`` restricts to the first year."""
    sy = scheduled.select(key, (F.col("ScheduledRepayment") * F.lit(12)).alias("_sy"))
    b = balances if max_month is None else balances.filter(F.col("Month") <= max_month)
    ay = b.groupBy(key).agg(F.coalesce(F.sum("ActualRepayment"), F.lit(0.0)).alias("_ay"))
    aligned = sy.join(ay, key, "full_outer")
    flag = _yearly_default(F.col("_sy"), F.col("_ay"))
    return aligned.agg((F.avg(flag.cast("int")) * F.lit(100.0)).alias(name))


def prepayment_cpr(balances: DataFrame, variant: str = "scheduled", scope: str = "loan_month",
                   name: str = "cpr_percent") -> DataFrame:
    """Annualised CPR in percent from the geometric-mean SMM over all
    loan-months with a positive start balance.

    SMM = max(0, principal paid - scheduled principal) / start balance;
    SMM_mean = (prod(1 + SMM))^(1/12) - 1; CPR = 1 - (1 - SMM_mean)^12; 0.0
    when no month qualifies.  With ``scope="loan_month"`` (the literal formula) the
    product has a factor for every loan-month but the root stays the 12th, so the
    answer depends on the portfolio's size and runs to minus infinity for a large
    one.  ``scope="month"`` is the form for portfolios: a month's SMM is the total
    excess over the total start balance of all loans, the mean is taken over the
    portfolio's months, and the answer is finite at any size.  Variants of the exploratory drafts:
    ``"gross"`` subtracts the whole scheduled payment; ``"median"`` subtracts
    the global median scheduled principal (taken over all months) and clips
    SMM to [0, 1].  Sums are :func:`~ledgerline.operators.exact.exact_sums`: the answer is the same to the
    last bit under any partitioning."""
    if scope not in ("loan_month", "month"):
        raise ValueError(f"unknown scope {scope!r}")
    paid = F.col("LoanBalanceStart") - F.col("LoanBalanceEnd")
    rows = balances
    if variant == "scheduled":
        excess = paid - (F.col("ScheduledRepayment") - F.col("InterestPayment"))
    elif variant == "gross":
        excess = paid - F.col("ScheduledRepayment")
    elif variant == "median":
        # read twice: by the selection and by the sums
        rows = freeze(balances.select("Month", "LoanBalanceStart", "LoanBalanceEnd", "ScheduledRepayment", "InterestPayment"), "months")
        med = exact_median(rows.select(
            (F.col("ScheduledRepayment") - F.col("InterestPayment")).alias("_sp")), "_sp")
        rows = rows.withColumn("_med", med)       # the scalar is bound once
        excess = paid - F.col("_med")
    else:
        raise ValueError(f"unknown variant {variant!r}")
    if scope == "month":
        cells = (rows.filter(F.col("LoanBalanceStart") > 0)
                 .select("Month", excess.alias("_x"), F.col("LoanBalanceStart").alias("_b"))
                 .filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
                 .select("Month", clip("_x", lower=0).alias("_x"), "_b"))
        by_month = (exact_sums(cells, ["Month"], {"_x": F.col("_x"), "_b": F.col("_b")})
                    .select(F.try_divide("_x", "_b").alias("_smm")))
        if variant == "median":
            by_month = by_month.select(clip("_smm", lower=0, upper=1).alias("_smm"))
        mean = (exact_sums(by_month, [], {"_s": F.log1p("_smm")}, rows="_n")
                .select(F.expm1(F.try_divide("_s", "_n")).alias("_mean")))
        yearly = (F.lit(1.0) - F.pow(F.lit(1.0) - F.col("_mean"), F.lit(12.0))) * F.lit(100.0)
        return mean.select(F.coalesce(yearly, F.lit(0.0)).alias(name))
    # each step is its own column so clip() refers to it by name; Spark may divide before it filters
    months = (rows.filter(F.col("LoanBalanceStart") > 0)
              .select(excess.alias("_x"), F.col("LoanBalanceStart").alias("_b"))
              .select(F.try_divide(clip("_x", lower=0), F.col("_b")).alias("_smm")))
    if variant == "median":
        months = months.select(clip("_smm", lower=0, upper=1).alias("_smm"))
    months = months.filter(F.col("_smm").isNotNull() & ~F.isnan("_smm"))
    agg = exact_sums(months, [], {"_s": F.log1p("_smm")}, rows="_n")
    smm_mean = F.expm1(F.col("_s") / F.lit(12.0))
    cpr = (F.lit(1.0) - F.pow(F.lit(1.0) - smm_mean, F.lit(12.0))) * F.lit(100.0)
    return agg.select(F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(cpr).alias(name))


def expected_loss(balances: DataFrame, key: str = "LoanID", year_months: int = 12,
                  recovery_rate: float = RECOVERY_RATE,
                  name: str = "expected_loss") -> DataFrame:
    """PD x balance entering year two x (1 - recovery).

    PD is the type-2 rate over each loan's first ``year_months`` months (the
    scheduled payment is the loan's first non-missing one; a loan without such
    months is not a default but is counted); the balance is the sum of start
    balances at month ``year_months + 1`` (0.0 when there is none).  One pass
    per loan, then one global aggregate -- no cross join of scalars.  The balances are added
    exactly; a loan's own payments, a year's rows that are only compared with its schedule, are a plain sum."""
    in_year = F.col("Month") <= year_months
    per_loan = balances.groupBy(key).agg(
        F.min_by(F.col("ScheduledRepayment"),
                 F.when(F.col("ScheduledRepayment").isNotNull(), F.col("Month"))).alias("_sched"),
        F.max(in_year).alias("_has_year"),
        F.sum(F.when(in_year, F.col("ActualRepayment"))).alias("_paid"),
        F.sum(F.when(F.col("Month") == year_months + 1, F.col("LoanBalanceStart"))).alias("_next"))
    sy = F.col("_sched") * F.lit(12)
    ay = F.when(F.col("_has_year"), F.coalesce(F.col("_paid"), F.lit(0.0)))
    flag = _yearly_default(sy, ay)
    # the flags are summed as whole numbers beside the balances
    summary = exact_sums(per_loan, [], {"_d": flag.cast("double"), "_bal": F.col("_next")}, rows="_n")
    pd = F.col("_d") / F.nullif(F.col("_n"), F.lit(0))
    return summary.select(
        (pd * F.coalesce("_bal", F.lit(0.0)) * F.lit(1.0 - recovery_rate)).alias(name))
