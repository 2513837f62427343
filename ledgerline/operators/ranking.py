"""Window operators over few, large groups (C13-C15).

Gender and age category have a handful of values, so ``PARTITION BY`` them
would put each group in one task.  The defaults walk a range-sorted layout once
(:mod:`~ledgerline.operators.ranges`).  ``method="scan"`` numbers rows with
:func:`~ledgerline.operators.positions.ordered_position` and joins on the numbers,
``method="window"`` is the direct SQL shape, one task per group; both for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ledgerline.functions.casts import sql_int
from ledgerline.functions.categories import age_category
from ledgerline.functions.ordering import asc, sort_spec
from ledgerline.operators.positions import position
from ledgerline.operators.ranges import cyclic_lead, dense_rank
from ledgerline.session import freeze
from ledgerline.sources.sinks import replace_table


def _position(df, group_cols, order, method, pos_col, size_col=None):
    return position(df, group_cols, order, pos_col, size_col, method)


def cyclic_shift(df: DataFrame, group: str = "Gender", order=("CustomerID",),
                 col: str = "Age", k: int = 2, out: str = "CorrectedAge",
                 keep=("CustomerID", "Age"), method: str = "halo") -> DataFrame:
    """Each row takes ``col`` from the row ``k`` places later in its group
    (wrapping from the end to the start), i.e. row ``rn`` receives row
    ``((rn + k - 1) mod n) + 1``.  ``k < 0`` looks back.  Rows whose group is
    NULL are dropped, as the reference's equi-join does.

    ``method="halo"`` (default, any ``k``): :func:`~ledgerline.operators.ranges.cyclic_lead`; only
    ``k`` rows at the edges of a range move.  ``method="scan"`` and ``"window"``: positions, then an
    equi-join on (group, position).  ``col`` and the kept columns break ties of ``order`` (duplicated
    ids), so the numbering is reproducible."""
    order = list(order) + [c for c in dict.fromkeys([col, *(keep if method == "halo" else [])])
                           if c not in [o[0] if isinstance(o, tuple) else o for o in order]]
    narrow = df.select(*dict.fromkeys([*keep, group, col, *(o[0] if isinstance(o, tuple) else o for o in order)]))
    if method == "halo":
        shifted = cyclic_lead(narrow, group, order, col, k, "_shifted")
        return (shifted.select(*keep, F.col("_shifted").alias(out), group)
                .orderBy(*sort_spec([group] + list(keep))))
    numbered = _position(narrow.filter(F.col(group).isNotNull()), [group], order,
                         method, "_pos", "_cnt")
    target = F.pmod(F.col("_pos") - F.lit(1) + F.lit(k), F.col("_cnt")) + F.lit(1)
    left = numbered.select(*keep, group, target.alias("_tpos"))
    right = numbered.select(F.col(group).alias("_g"), F.col("_pos").alias("_spos"),
                            F.col(col).alias(out))
    joined = left.join(right, (left[group] == right["_g"]) & (left["_tpos"] == right["_spos"]))
    return (joined.select(*keep, out, group)
                  .orderBy(*sort_spec([group] + list(keep))))


def with_age_category(df: DataFrame, col: str = "CorrectedAge",
                      out: str = "AgeCategory") -> DataFrame:
    return df.withColumn(out, age_category(F.col(col)))


def _is_fractional(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (DoubleType, FloatType, DecimalType))


def rank_in_category(corrected: DataFrame, repayments: DataFrame, key: str = "CustomerID",
                     age_col: str = "CorrectedAge", amount: str = "Amount",
                     metric: str = "sum", method: str = "walk",
                     cols=("CustomerID", "Age", "CorrectedAge", "Gender")) -> DataFrame:
    """Dense rank of each customer's repayment total within its age category
    (highest first, no gaps; customers without repayments count 0; a NULL
    category is its own group).  ``metric="count"`` ranks by the number of
    repayments instead of their amount.

    ``method="walk"`` (default): :func:`~ledgerline.operators.ranges.dense_rank`, one sort and
    one write.  ``method="window"`` is ``dense_rank`` over ``PARTITION BY`` category.
    ``method="scan"`` numbers the distinct (category, total) pairs with the
    range scan (the position among distinct values *is* the dense rank) and
    joins the rank back null-safely; a hot total (e.g. the many customers
    with none) is split by AQE's skew-join handling.  The categorised frame is written
    once, as both the numbering and the join read it."""
    if metric == "sum":
        s = F.sum(F.coalesce(F.col(amount), F.lit(0)))
        total = sql_int(s, "bigint") if _is_fractional(repayments, amount) else s.cast("bigint")
    elif metric == "count":
        total = F.count(F.lit(1))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    totals = repayments.groupBy(key).agg(total.alias("_tot"))
    categorized = (with_age_category(corrected, age_col)
                   .join(totals, key, "left")
                   .withColumn("_tot", F.coalesce(F.col("_tot"), F.lit(0).cast("bigint"))))
    if method == "walk":
        ranked = dense_rank(categorized, "AgeCategory", "_tot", "Rank")
    elif method == "window":  # the direct form
        w = Window.partitionBy("AgeCategory").orderBy(F.col("_tot").desc_nulls_last())
        ranked = categorized.withColumn("Rank", F.dense_rank().over(w).cast("bigint"))
    elif method == "scan":
        categorized = freeze(categorized, "categories")
        distinct = categorized.select("AgeCategory", "_tot").distinct()
        ranks = _position(distinct, ["AgeCategory"], [("_tot", False)], method, "Rank")
        ranks = ranks.select(F.col("AgeCategory").alias("_c"), F.col("_tot").alias("_t"),
                             F.col("Rank").cast("bigint").alias("Rank"))
        ranked = categorized.join(
            ranks, categorized["AgeCategory"].eqNullSafe(ranks["_c"])
            & (categorized["_tot"] == ranks["_t"]))
    else:
        raise ValueError(f"unknown method {method!r}")
    return (ranked.select(*cols, "AgeCategory", "Rank")
                  .orderBy(asc("Gender"), asc("AgeCategory"), asc(key)))


def save_corrected_customers(customers: DataFrame, name: str = "corrected_customers",
                             **options) -> DataFrame:
    """``CREATE OR REPLACE TABLE corrected_customers AS ...`` for
    :func:`cyclic_shift`; returns the stored table."""
    return replace_table(cyclic_shift(customers, **options), name)
