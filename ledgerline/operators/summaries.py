"""Cleaning, summary and extract operators over one to three tables (C1-C9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.casts import text, try_double, try_int
from ledgerline.functions.categories import normalise_province
from ledgerline.functions.ordering import asc, desc, sort_spec
from ledgerline.operators.joins import left_join
from ledgerline.sources.schemas import FINANCING
from ledgerline.sources.sinks import (
    append_table, create_table_if_absent, replace_table, update_where,
)
from ledgerline.sources.versions import StoredTable


def _cols(df: DataFrame, cols) -> list[str]:
    return list(cols) if cols else df.columns


def duplicate_rows(df: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Every row whose key occurs more than once (``WHERE k IN (SELECT k ...
    GROUP BY k HAVING COUNT(*) > 1)``).  NULL keys never match, as with ``IN``.

    The key count is a partial+final hash aggregate (a hot key is reduced to one
    row per map task before the shuffle); the semi join is split by AQE when a
    key is skewed, or becomes a broadcast when the duplicate-key set is small."""
    dup_keys = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).select(*keys))
    out_cols = _cols(df, cols)
    # the other output columns break ties, so a hot key's rows can still be
    # spread over several range partitions of the final sort
    return (df.join(dup_keys, keys, "left_semi")
              .select(*out_cols)
              .orderBy(*sort_spec(keys + [c for c in out_cols if c not in keys])))


def dedup_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first under ``order`` (NULLS LAST).

    Expressed as ``row_number() = 1`` so Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle: each map task keeps only its own
    first row per key, so a hot key ships one row per task, not all of them.
    Pass tie-breaker columns in ``order``; the reference leaves ties undefined."""
    w = Window.partitionBy(*keys).orderBy(*sort_spec(order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def filtered_ranking(customers: DataFrame, gender: str, key: str = "CustomerID",
                     order: list | None = None, value: str = "Income",
                     cols: list[str] | None = None) -> DataFrame:
    """Deduplicate first, then keep one gender (exact, case-sensitive match)
    with a non-NULL value, highest value first.  Rows of one key are ordered by
    ``order`` (Name) and then by every other column, so the kept row is
    reproducible even when a duplicated key ties on Name."""
    order = list(order or ["Name"])
    order += [c for c in customers.columns if c != key and c not in order]
    first = dedup_first(customers, [key], order)
    out_cols = list(cols or ["Name", "Surname", value])
    return (first.filter((F.col("Gender") == F.lit(gender)) & F.col(value).isNotNull())
                 .select(*out_cols)
                 .orderBy(desc(value), *sort_spec([c for c in out_cols if c != value])))


def guarded_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``ROUND(100.0 * part / NULLIF(whole, 0), digits)`` computed in double
    (a decimal literal would keep DECIMAL through the division)."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0)), digits)


def conditional_rate(loans: DataFrame, group: str = "LoanTerm",
                     status: str = "ApprovalStatus", value: str = "Approved",
                     dedup_key: str | None = None) -> DataFrame:
    """Approval percentage per group: rows with a NULL status are left out, a
    NULL group is its own group.  ``dedup_key`` keeps one row per key first
    (the reference counts duplicates)."""
    df = loans
    if dedup_key:
        df = dedup_first(df, [dedup_key], [c for c in df.columns if c != dedup_key])
    hit = F.when(F.col(status) == F.lit(value), 1).otherwise(0)
    return (df.filter(F.col(status).isNotNull())
              .groupBy(group)
              .agg(F.count(F.lit(1)).alias("TotalLoans"), F.sum(hit).alias("ApprovedLoans"))
              .select(group, "TotalLoans", "ApprovedLoans",
                      guarded_percent(F.col("ApprovedLoans"), F.col("TotalLoans"))
                      .alias("ApprovedPercentage"))
              .orderBy(asc(group)))


def category_counts(df: DataFrame, col: str = "CustomerClass", name: str = "Count") -> DataFrame:
    """Rows per category, largest first (ties by category for a stable order)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
              .orderBy(desc(name), asc(col)))


def conditional_update(credit: DataFrame, low: int = 600, high: int = 650,
                       score: str = "CreditScore", col: str = "CustomerClass",
                       value: str = "C") -> DataFrame:
    """``UPDATE credit SET class = 'C' WHERE score BETWEEN low AND high`` then
    the counts per class.  Both bounds are inclusive; a NULL score is unchanged."""
    updated = update_where(credit, col, value, F.col(score).between(low, high))
    return category_counts(updated, col)


def stored_update(table: StoredTable, low: int = 600, high: int = 650, score: str = "CreditScore",
                  col: str = "CustomerClass", value: str = "C") -> DataFrame:
    """:func:`conditional_update` on a stored table: the update is written to it, then its
    classes are counted."""
    return category_counts(table.update(col, value, F.col(score).between(low, high)), col)


def joined_group_mean(credit: DataFrame, customers: DataFrame, key: str = "CustomerID",
                      group: str = "CustomerClass", value: str = "Income",
                      name: str = "AverageIncome") -> DataFrame:
    """Mean of the cleaned value per class over the inner join; values that do
    not parse are dropped before averaging (duplicates weight the mean).

    The mean over join pairs is computed without materialising the pairs: a
    key with ``a`` credit rows of a class and ``b`` valid customer rows summing
    to ``s`` contributes ``a*s`` and ``a*b``.  Both sides are aggregated per
    key before the join (a hot key is one row on each side), so the join and
    the final aggregate move one row per key.  For integer-valued inputs this
    is exact; otherwise it equals the pairwise sum up to rounding."""
    v = try_double(F.col(value))
    cust = (customers.select(key, v.alias("_v")).filter(F.col("_v").isNotNull())
            .groupBy(key).agg(F.sum("_v").alias("_s"), F.count(F.lit(1)).alias("_b")))
    cred = credit.groupBy(key, group).agg(F.count(F.lit(1)).alias("_a"))
    pairs = cred.join(cust, key)
    return (pairs.groupBy(group)
                 .agg((F.sum(F.col("_a") * F.col("_s")) / F.sum(F.col("_a") * F.col("_b")))
                      .alias(name))
                 .orderBy(asc(group)))


def normalised_counts(customers: DataFrame, loans: DataFrame, key: str = "CustomerID",
                      region: str = "Region", status: str = "ApprovalStatus",
                      value: str = "REJECTED", name: str = "RejectedApplications") -> DataFrame:
    """Rejected applications per normalised province (``UPPER(TRIM(s)) =
    'REJECTED'``), counted over customer x loan pairs like the reference join.

    Rejected loans are counted per key and customers per (key, province)
    before the join, so a customer with a large share of the loans is one row
    on each side; the pair count is the product of the two counts."""
    rejected = (loans.filter(F.upper(F.trim(F.col(status))) == F.lit(value))
                .groupBy(key).agg(F.count(F.lit(1)).alias("_r")))
    cust = (customers.select(key, normalise_province(F.col(region)).alias("Province"))
            .groupBy(key, "Province").agg(F.count(F.lit(1)).alias("_c")))
    pairs = cust.join(rejected, key)
    return (pairs.groupBy("Province").agg(F.sum(F.col("_c") * F.col("_r")).alias(name))
                 .orderBy(asc("Province")))


def wide_extract(customers: DataFrame, credit: DataFrame, loans: DataFrame,
                 key: str = "CustomerID", join_method: str = "salted") -> DataFrame:
    """The ``financing`` extract: customers LEFT JOIN credit LEFT JOIN loans,
    with every field cleaned through ``TRY_CAST(TRIM(x))``.  Customers without
    credit or loans keep one row with NULLs; duplicate keys fan out.  The LEFT
    joins are :func:`~ledgerline.operators.joins.left_join`, which Spark can
    split where one customer holds a large share of the loans."""
    c = customers.select(key, "Income")
    cr = credit.select(key, "CreditScore")
    lo = loans.select(key, "LoanAmount", "LoanTerm", "InterestRate", "ApprovalStatus")
    j = left_join(left_join(c, cr, key, join_method), lo, key, join_method)
    return j.select(
        F.col(key).alias("CustomerID"),
        try_double("Income").alias("Income"),
        try_double("LoanAmount").alias("LoanAmount"),
        try_int("LoanTerm").alias("LoanTerm"),
        try_double("InterestRate").alias("InterestRate"),
        text("ApprovalStatus").alias("ApprovalStatus"),
        try_int("CreditScore").alias("CreditScore"))


def save_financing(customers: DataFrame, credit: DataFrame, loans: DataFrame,
                   name: str = "financing", mode: str = "overwrite") -> DataFrame:
    """Write :func:`wide_extract` as table ``name`` and return the table.

    ``mode="append"`` is the reference's ``CREATE TABLE IF NOT EXISTS`` +
    ``INSERT INTO`` (each run adds the rows again); the default
    ``"overwrite"`` makes a re-run idempotent."""
    spark = customers.sparkSession
    extract = wide_extract(customers, credit, loans)
    if mode == "append":
        create_table_if_absent(spark, name, FINANCING)
        append_table(extract, name)
        return spark.table(name)
    if mode == "overwrite":
        return replace_table(extract, name)
    raise ValueError(f"unknown mode {mode!r}")
