"""Row positions within a group without one window partition per group.

``ROW_NUMBER() OVER (PARTITION BY g ORDER BY o)`` puts every row of a group in
one task.  When the group key has few values (gender, age category) or one
value holds a large share of the rows, that task holds most of the data.

:func:`ordered_position` computes the same numbers with work spread over all
tasks:

1. a global sort on ``(g, o)`` range-partitions the rows, so one large group
   is split over many partitions by its order key;
2. each row records its partition id and its index inside the partition
   (``monotonically_increasing_id`` is ``partition << 33 | index``), and the
   layout is frozen -- written as a Parquet table in the cluster's reliable
   checkpoint folder -- so that recomputation after a lost executor cannot
   renumber rows;
3. a small table with one row per (partition, group) holds the row count and
   the first index; a window over that table (at most one row per partition
   for each group) turns counts into offsets;
4. position = offset + (index - first index) + 1.

The side table has about ``#groups + #partitions`` rows; AQE broadcasts it
when its measured size is small (few groups) and otherwise joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.ordering import sort_spec
from ledgerline.session import freeze as freeze_layout

_PID, _RID, _N, _FIRST, _OFF = "_lp_pid", "_lp_rid", "_lp_n", "_lp_first", "_lp_off"


def ordered_position(df: DataFrame, group_cols: list[str], order: list,
                     pos_col: str = "pos", size_col: str | None = None) -> DataFrame:
    """Add ``pos_col`` = 1-based position of the row in its group under
    ``order`` (NULLS LAST, like the reference engine; ``("c", False)`` is DESC)
    and optionally ``size_col`` = number of rows in the group.

    NULL group values form one group, as in ``PARTITION BY``.  ``order`` should
    be a total order (add tie-breaker columns) for reproducible numbering;
    exact duplicate rows may be numbered either way round, which cannot be
    observed."""
    group_cols = list(group_cols)
    keys = sort_spec(group_cols) + sort_spec(order)
    tagged = freeze_layout(df.orderBy(*keys)
                           .withColumn(_PID, F.spark_partition_id())
                           .withColumn(_RID, F.monotonically_increasing_id()), "positions")

    stats = tagged.groupBy(_PID, *group_cols).agg(
        F.count(F.lit(1)).alias(_N), F.min(_RID).alias(_FIRST))
    before = (Window.partitionBy(*group_cols).orderBy(_PID)
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0)))
    if size_col:
        stats = stats.withColumn(size_col, F.sum(_N).over(Window.partitionBy(*group_cols)))
    stats = stats.select(
        F.col(_PID).alias("_s_pid"), *[F.col(g).alias(f"_s_{g}") for g in group_cols],
        _OFF, _FIRST, *([size_col] if size_col else []))

    cond = [tagged[_PID] == stats["_s_pid"]] + [
        tagged[g].eqNullSafe(stats[f"_s_{g}"]) for g in group_cols]
    joined = tagged.join(stats, cond, "inner")
    out_cols = [c for c in df.columns]
    return joined.select(
        *out_cols,
        (F.col(_OFF) + (F.col(_RID) - F.col(_FIRST)) + F.lit(1)).alias(pos_col),
        *([F.col(size_col)] if size_col else []))


def window_position(df: DataFrame, group_cols: list[str], order: list,
                    pos_col: str = "pos", size_col: str | None = None) -> DataFrame:
    """The direct form: ``row_number`` (and ``count``) over ``PARTITION BY``.
    Right when the group key has many values and none is hot."""
    w = Window.partitionBy(*group_cols).orderBy(*sort_spec(order))
    out = df.withColumn(pos_col, F.row_number().over(w).cast("bigint"))
    if size_col:
        out = out.withColumn(size_col, F.count(F.lit(1)).over(Window.partitionBy(*group_cols)))
    return out


def position(df: DataFrame, group_cols: list[str], order: list, pos_col: str = "pos",
             size_col: str | None = None, method: str = "scan") -> DataFrame:
    """Row positions by ``"scan"`` (:func:`ordered_position`) or ``"window"``
    (:func:`window_position`, for groups known to be small)."""
    if method not in ("scan", "window"):
        raise ValueError(f"unknown method {method!r}")
    of = ordered_position if method == "scan" else window_position
    return of(df, group_cols, order, pos_col, size_col)


def cumulative_weight(df: DataFrame, order: list, weight: str, out: str = "_cum") -> DataFrame:
    """Inclusive running sum of ``weight`` over the whole frame in ``order``
    (a total order), without a single-task window over the data.

    Range-sort, freeze (partition id, row index), take each
    partition's total weight, turn totals into offsets over a table of one row
    per partition, then add the running sum *inside* each range partition --
    a window partitioned by the partition id, i.e. balanced by construction."""
    keys = sort_spec(order)
    tagged = freeze_layout(df.orderBy(*keys)
                           .withColumn(_PID, F.spark_partition_id())
                           .withColumn(_RID, F.monotonically_increasing_id()), "cumulative")
    totals = tagged.groupBy(_PID).agg(F.sum(weight).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(_PID).alias("_s_pid"),
                            F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local = Window.partitionBy(_PID).orderBy(_RID).rowsBetween(Window.unboundedPreceding,
                                                               Window.currentRow)
    with_local = tagged.withColumn("_lp_local", F.sum(weight).over(local))
    joined = with_local.join(offsets, with_local[_PID] == offsets["_s_pid"])
    return joined.select(*df.columns, (F.col(_OFF) + F.col("_lp_local")).alias(out))
