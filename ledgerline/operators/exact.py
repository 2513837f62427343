"""Sums of doubles that do not depend on the order or the partitioning of the rows.

Every double is a whole number times a power of two.  Rows are grouped by that power, in steps of ``STEP``, and the whole
numbers of a group are added as decimals, which is exact; a group of rows has at most about 550 powers, so the
partial sums before the shuffle are few.  At the end the powers of one group are added as whole
numbers and rounded once.  The result is the double nearest to the true sum, whatever the partitioning: after a lost
executor, on another cluster or under AQE it is the same to the last bit.

A group with a third of all rows is one row per task and power before the shuffle."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 4
#: Powers that stand for what is no whole number times a power of two.
NAN, INFINITE, MINUS_INFINITE = 5000, 5001, 5002


def _power(x: Column) -> Column:
    """A power of two, as its exponent, of which ``x`` is a multiple by less than 2**59."""
    whole = (F.floor((F.floor(F.log2(F.abs(x))) - 53) / F.lit(float(STEP))) * STEP).cast("int")
    return (F.when(x.isNull(), F.lit(None)).when(F.isnan(x), NAN).when(x == float("inf"), INFINITE)
            .when(x == float("-inf"), MINUS_INFINITE).when(x == 0, 0).otherwise(whole).cast("int"))


def _multiple(x: Column, power: Column) -> Column:
    """``x / 2**power`` as a whole number; very small numbers are scaled in two steps, as 2**1100 is no double."""
    small = power < -1000
    scaled = F.when(small, x * F.lit(2.0 ** 600)).otherwise(x) * F.pow(F.lit(2.0), F.when(small, -power - 600).otherwise(-power).cast("double"))
    return F.when(power < NAN, F.when(x == 0, F.lit(0.0)).otherwise(scaled)).cast("bigint").cast("decimal(28,0)")


def rounded_total(powers, multiples) -> float | None:
    """The double nearest to the sum of ``multiples * 2**powers``."""
    terms = [(int(p), int(m)) for p, m in zip(powers, multiples) if p < NAN]
    if not terms:
        return None
    low = min(p for p, _ in terms)
    whole = sum(m << (p - low) for p, m in terms)
    try:
        return float(whole << low) if low >= 0 else whole / (1 << -low)
    except OverflowError:
        return float("inf") if whole > 0 else float("-inf")


def exact_sums(df: DataFrame, by: list[str], values: dict[str, Column], rows: str | None = None) -> DataFrame:
    """``by`` and, under each name of ``values``, the exactly rounded sum of that column, as SQL's SUM has it otherwise:
    NULLs don't count, NULL where there is nothing else; NaN, or both infinities, give NaN, one infinity itself.
    ``rows`` names a column for the number of rows.  Without ``by``: one row, also for an empty table."""
    @F.pandas_udf("double")
    def total(powers: pd.Series, multiples: pd.Series) -> pd.Series:
        return pd.Series([rounded_total(p, m) for p, m in zip(powers, multiples)], dtype="float64")

    doubles = [c.cast("double") for c in values.values()]
    if len(doubles) == 1:
        cells = df.select(*by, F.lit(0).alias("_ei"), doubles[0].alias("_ex"))
    else:
        # outer: the arrays are never empty, and Spark adds no filter that has every value computed twice
        cells = df.select(*by, F.posexplode_outer(F.array(*doubles)).alias("_ei", "_ex"))
    cells = cells.withColumn("_ep", _power(F.col("_ex")))
    bins = (cells.select(*by, "_ei", "_ep", _multiple(F.col("_ex"), F.col("_ep")).alias("_em"))
            .groupBy(*by, "_ei", "_ep").agg(F.coalesce(F.sum("_em"), F.lit(0)).cast("decimal(38,0)").alias("_em"), F.count(F.lit(1)).alias("_er")))
    there = F.col("_ep").isNotNull()
    groups = bins.groupBy(*by, "_ei").agg(F.collect_list(F.when(there, F.col("_ep"))).alias("_ep"),
                                          F.collect_list(F.when(there, F.col("_em"))).alias("_em"), F.sum("_er").alias("_er"))

    def has(code: int) -> Column:
        return F.array_contains("_ep", F.lit(code))
    value = (F.when(has(NAN) | (has(INFINITE) & has(MINUS_INFINITE)), F.lit(float("nan"))).when(has(INFINITE), F.lit(float("inf")))
             .when(has(MINUS_INFINITE), F.lit(float("-inf"))).otherwise(F.col("_et")))
    sums = groups.withColumn("_et", total("_ep", "_em")).select(*by, "_ei", "_er", value.alias("_et"))
    out = [F.max(F.when(F.col("_ei") == i, F.col("_et"))).alias(name) for i, name in enumerate(values)]
    if rows:
        out.append(F.coalesce(F.max("_er"), F.lit(0)).cast("bigint").alias(rows))
    return sums.groupBy(*by).agg(*out)
