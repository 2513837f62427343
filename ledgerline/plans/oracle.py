"""Equivalent DuckDB SQL for every catalog query (the correctness oracle).

The role views of :mod:`ledgerline.sources.roles` are written once as CTEs;
each query text picks the ones it needs.  Numeric conventions shared with the
Spark side: the monthly rate is the double ``0.1/12``; half-to-even cents are
``CAST(x * 100 AS BIGINT) / 100`` (DuckDB's double->integer cast rounds half
to even, like numpy's ``rint``); integer sums are cast to BIGINT.
"""

from __future__ import annotations

from ledgerline.functions.categories import AGE_BUCKETS, PROVINCE_SPELLINGS
from ledgerline.functions.time import MONTH_NAMES, ZONE_ALIASES
from ledgerline.sources.roles import (NO_AMOUNT, NO_PAYMENT, NO_STATUS, PROVINCES_AS_TYPED, UNPAID_USERS,
                                      ZONES_AS_TYPED)

R = "(0.1::DOUBLE / 12)"
#: Amount of a loan that was never paid.
UNPAID = "500.0::DOUBLE + CAST((user_id * 37 + spare * 11) % 50 AS DOUBLE) * 40.0::DOUBLE"


def cents(x: str) -> str:
    return f"(CAST(({x}) * 100.0::DOUBLE AS BIGINT) / 100.0::DOUBLE)"


def text(x: str) -> str:
    return f"TRIM(CAST({x} AS VARCHAR))"


def try_double(x: str) -> str:
    return f"TRY_CAST({text(x)} AS DOUBLE)"


def try_int(x: str) -> str:
    return f"TRY_CAST({text(x)} AS INTEGER)"


def typed(x: str, values: list, of: int, rest: str = "NULL") -> str:
    """The i-th value where ``x % of`` is i."""
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {x} % {of} {arms} ELSE {rest} END"


ROLE = {
    "customers": """customers AS (
    SELECT c.c_custkey AS CustomerID, c.c_name AS Name, n.n_name AS Surname,
           CASE WHEN c.c_custkey % 50 = 0 THEN NULL
                ELSE CAST(15 + (c.c_custkey * 7) % 60 AS INTEGER) END AS Age,
           c.c_mktsegment AS Gender, CAST(floor(c.c_acctbal) AS INTEGER) AS Income,
           r.r_name AS Region
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "raw_customers": f"""raw_customers AS (
    SELECT CustomerID, unnest(CASE WHEN CustomerID % 37 = 0 THEN [Name, Name || ' (copy)'] ELSE [Name] END) AS Name,
           Surname, Age, CASE WHEN CustomerID % 29 <> 0 THEN Gender END AS Gender,
           CASE CustomerID % 11 WHEN 0 THEN NULL WHEN 1 THEN '  ' || Income || ' ' WHEN 2 THEN 'n/a'
                                WHEN 3 THEN Income || '.5' ELSE Income::VARCHAR END AS Income,
           {typed('CustomerID', PROVINCES_AS_TYPED, 20, 'Region')} AS Region
    FROM customers)""",
    "raw_loans": f"""raw_loans AS (
    SELECT CustomerID, InterestRate, ApprovalStatus,
           CASE OrderKey % 17 WHEN 0 THEN NULL WHEN 1 THEN ' ' || LoanAmount || ' ' WHEN 2 THEN 'R' || LoanAmount
                              WHEN 3 THEN LoanAmount || '.25' ELSE LoanAmount::VARCHAR END AS LoanAmount,
           CASE OrderKey % 13 WHEN 0 THEN LoanTerm || '.5' WHEN 1 THEN ' ' || LoanTerm || '  ' WHEN 2 THEN 'long'
                              WHEN 3 THEN LoanTerm || '.4' ELSE LoanTerm::VARCHAR END AS LoanTerm
    FROM keyed_loans)""",
    "loans": "loans AS (SELECT * EXCLUDE (OrderKey) FROM keyed_loans)",
    "keyed_loans": f"""keyed_loans AS (
    SELECT o_orderkey AS OrderKey, o_custkey AS CustomerID, CAST(floor(o_totalprice) AS INTEGER) AS LoanAmount,
           12 * TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS LoanTerm,
           CAST(CAST(400 + (o_orderkey * 37) % 451 AS DOUBLE) / 100.0::DOUBLE AS FLOAT)
               AS InterestRate,
           CASE WHEN o_orderkey % {NO_STATUS} = 0 THEN NULL
                ELSE CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Rejected'
                                        WHEN 'P' THEN ' rejected' ELSE o_orderstatus END END AS ApprovalStatus
    FROM orders)""",
    "credit": """credit AS (
    SELECT p_partkey AS CustomerID, p_size AS CreditScore, p_type AS CustomerClass FROM part)""",
    "repayments": f"""repayments AS (
    SELECT event_id AS RepaymentID, ts AS RepaymentDate,
           CASE WHEN event_id % {NO_AMOUNT} <> 0 THEN CAST(floor(value) AS INTEGER) END AS Amount,
           user_id AS CustomerID,
           CASE user_id % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Kolkata'
                            WHEN 2 THEN 'UTC' END AS TimeZone
    FROM events)""",
    "monthly_repayments": f"""monthly_repayments AS (
    SELECT o_orderkey AS RepaymentID, o_orderdate::TIMESTAMP + to_hours(4 + o_orderkey % 20) AS RepaymentDate,
           CASE WHEN o_orderkey % {NO_AMOUNT} <> 0
                THEN floor(o_totalprice)::DOUBLE + (1 - o_orderkey % 2) * 0.5::DOUBLE END AS Amount,
           o_custkey AS CustomerID, {typed('o_custkey', ZONES_AS_TYPED, len(ZONES_AS_TYPED))} AS TimeZone
    FROM orders)""",
    "night_repayments": f"""night_repayments AS (
    SELECT o_orderkey AS RepaymentID, o_orderdate::TIMESTAMP + to_hours(o_orderkey % 4) + to_minutes(o_orderkey % 60) AS RepaymentDate,
           o_custkey AS CustomerID, {typed('o_custkey', ZONES_AS_TYPED, len(ZONES_AS_TYPED))} AS TimeZone
    FROM orders)""",
    "loan_months": f"""pos_events AS (
    SELECT user_id, value, event_id,
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
    FROM events),
loan_blocks AS (
    SELECT user_id * 4294967296 + (pos - 1) // 24 AS LoanID,
           CAST((pos - 1) % 24 + 1 AS INTEGER) AS Month, value, event_id,
           500.0::DOUBLE + CAST((user_id * 37 + ((pos - 1) // 24) * 11) % 50 AS DOUBLE)
               * 40.0::DOUBLE AS LoanAmount
    FROM pos_events),
loan_sched AS (
    SELECT *, {cents(f"LoanAmount * ({R} / (1.0::DOUBLE - pow(1.0::DOUBLE + {R}, -24.0::DOUBLE)))")}
              AS ScheduledRepayment
    FROM loan_blocks),
loan_months AS (
    SELECT LoanID, Month, LoanAmount, ScheduledRepayment,
           CASE WHEN event_id % {NO_PAYMENT} = 0 THEN NULL
                WHEN value < 3 THEN 0.0::DOUBLE
                WHEN value < 6 AND LoanID % 3 = 0 THEN {cents("ScheduledRepayment * 0.5::DOUBLE")}
                WHEN value > 300 THEN {cents("ScheduledRepayment * 1.5::DOUBLE")}
                ELSE ScheduledRepayment END AS ActualRepayment
    FROM loan_sched),
scheduled AS (
    SELECT LoanID, any_value(LoanAmount) AS LoanAmount,
           any_value(ScheduledRepayment) AS ScheduledRepayment
    FROM loan_months GROUP BY LoanID
    UNION ALL
    SELECT user_id * 4294967296 + spare, ({UNPAID}),
           {cents(f"({UNPAID}) * ({R} / (1.0::DOUBLE - pow(1.0::DOUBLE + {R}, -24.0::DOUBLE)))")}
    FROM (SELECT user_id, (count(*) - 1) // 24 + 1 AS spare FROM events
          WHERE user_id % {UNPAID_USERS} = 0 GROUP BY user_id)),
actual AS (SELECT LoanID, Month, ActualRepayment FROM loan_months)""",
    "balances": f"""merged AS (
    SELECT a.LoanID, a.Month, a.ActualRepayment, s.LoanAmount, s.ScheduledRepayment,
           ROW_NUMBER() OVER (PARTITION BY a.LoanID ORDER BY a.Month, a.ActualRepayment) AS step
    FROM actual a JOIN scheduled s USING (LoanID)),
roll AS (
    SELECT LoanID, step, Month, ActualRepayment, LoanAmount, ScheduledRepayment,
           LoanAmount AS b_start,
           CASE WHEN (LoanAmount + LoanAmount * {R}) - ActualRepayment > 0
                THEN (LoanAmount + LoanAmount * {R}) - ActualRepayment ELSE 0.0::DOUBLE END AS b_end,
           LoanAmount * {R} AS b_int
    FROM merged WHERE step = 1
    UNION ALL
    SELECT m.LoanID, m.step, m.Month, m.ActualRepayment, m.LoanAmount, m.ScheduledRepayment,
           p.b_end,
           CASE WHEN (p.b_end + p.b_end * {R}) - m.ActualRepayment > 0
                THEN (p.b_end + p.b_end * {R}) - m.ActualRepayment ELSE 0.0::DOUBLE END,
           p.b_end * {R}
    FROM roll p JOIN merged m ON m.LoanID = p.LoanID AND m.step = p.step + 1),
balances AS (
    SELECT LoanID, Month, ActualRepayment, LoanAmount, ScheduledRepayment,
           {cents("b_start")} AS LoanBalanceStart, {cents("b_end")} AS LoanBalanceEnd,
           {cents("b_int")} AS InterestPayment
    FROM roll)""",
}


#: Roles that a role is made from.
NEEDS = {"raw_customers": ["customers"], "loans": ["keyed_loans"], "raw_loans": ["keyed_loans"]}


def with_roles(roles: list[str], body: str, extra: list[str] | None = None) -> str:
    needed = list(dict.fromkeys(x for r in roles for x in (*NEEDS.get(r, ()), r)))
    ctes = [ROLE[r] for r in needed] + list(extra or [])
    recursive = "RECURSIVE " if "balances" in roles else ""
    return f"WITH {recursive}" + ",\n".join(ctes) + "\n" + body


def months_values() -> str:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(MONTH_NAMES, start=1))
    return f"months AS (SELECT * FROM (VALUES {rows}) AS t(MonthID, MonthName))"


def province_case(x: str) -> str:
    whens = []
    for name, keys in PROVINCE_SPELLINGS.items():
        lst = ", ".join(f"'{k}'" for k in keys)
        whens.append(f"WHEN UPPER(TRIM({x})) IN ({lst}) THEN '{name}'")
    return "CASE " + " ".join(whens) + f" ELSE TRIM({x}) END"


def age_case(x: str) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL"]
    for lo, hi, label in AGE_BUCKETS:
        cond = " AND ".join(([f"{x} >= {lo}"] if lo is not None else [])
                            + ([f"{x} < {hi}"] if hi is not None else []))
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def calendar_sql(facts: str, spine: str, period_expr: str, spine_id: str, spine_name: str,
                 hours: tuple | None, ts_expr: str = "RepaymentDate") -> tuple[list[str], str]:
    """CTE ``timeline``: per entity a map from period to its (count, sum), read once for every
    period of the spine, 0 where the map has none."""
    table = spine.split(' AS ')[0]
    within = f"hour({ts_expr}) BETWEEN {hours[0]} AND {hours[1]}" if hours else "true"
    extra = [
        spine,
        f"""entity_maps AS (
    SELECT id, map_from_entries(list((period, cell))) AS cells
    FROM (SELECT CustomerID AS id, {period_expr.format(ts=ts_expr)} AS period,
                 {{'n': count(*), 'amount': sum({try_double('Amount')})}} AS cell
          FROM {facts} WHERE {within} GROUP BY ALL)
    WHERE period IS NOT NULL GROUP BY id)""",
        f"""timeline AS (
    SELECT CustomerID, step.name AS {spine_name},
           coalesce(cells[step.id].n, 0) AS NumberOfRepayments,
           coalesce(cells[step.id].amount, 0)::DOUBLE AS AmountTotal
    FROM (SELECT CustomerID, cells,
                 unnest((SELECT list({{'id': {spine_id}, 'name': {spine_name}}}) FROM {table})) AS step
          FROM customers LEFT JOIN entity_maps ON id = CustomerID))"""]
    return extra, f"SELECT CustomerID, {spine_name}, NumberOfRepayments, AmountTotal FROM timeline"


DAYS = ("days AS (SELECT CAST(range AS INTEGER) AS DayID, CAST(range AS VARCHAR) AS DayOfMonth "
        "FROM range(1, 32))")
_REGION = ("CASE upper(trim(TimeZone)) "
           + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ZONE_ALIASES.items()) + " ELSE TimeZone END")
LONDON_TS = f"coalesce(timezone('Europe/London', timezone({_REGION}, RepaymentDate)), RepaymentDate)"
#: ``told``: night repayments with the instant that this engine takes, and whether the hour is skipped or repeated:
#: a skipped time isn't the instant's own wall-clock time, a repeated one is also that of an hour before.
TOLD = f"""told AS (
    SELECT *, CASE WHEN timezone(region, instant) <> RepaymentDate THEN 'skipped'
                   WHEN timezone(region, instant - INTERVAL 1 HOUR) = RepaymentDate THEN 'repeated' END AS ClockChange
    FROM (SELECT *, {_REGION} AS region, timezone({_REGION}, RepaymentDate) AS instant FROM night_repayments))"""


def sig9(x: str) -> str:
    """Round a double to 9 significant digits (same steps as the Spark side)."""
    e = f"(8 - floor(log10(abs({x}))))"
    up = f"pow(10.0::DOUBLE, {e})"
    down = f"pow(10.0::DOUBLE, -{e})"
    return (f"(CASE WHEN ({x}) IS NULL OR isnan({x}) OR ({x}) = 0 OR isinf({x}) THEN ({x}) "
            f"WHEN {e} >= 0 THEN round(({x}) * {up}) / {up} "
            f"ELSE round(({x}) / {down}) * {down} END)")
