"""Window operators over few, huge groups, on a range-sorted layout that is walked once.

A global sort by (group, order) cuts the rows into ranges; a group with most of the rows is spread over
many.  Each range is walked in order by one task, a batch of columns at a time, and written with what the walk
found out; what a range lacks comes from a side table of one row per range and group, or from the few rows at
its neighbours' edges.  The rows themselves are not shuffled a second time.

* :func:`cyclic_lead`: a row finds the row ``k`` places on in its own range.  Only a range's last ``k`` rows of a
  group look for theirs elsewhere, among the first ``k`` rows of the ranges of that group.
* :func:`dense_rank`: the walk counts distinct values; counts of earlier ranges are added, less one wherever a
  value goes on over the edge of a range.

Layouts are written to the checkpoint folder (ranges must not move between the steps), so a lost executor costs the
tasks that it ran."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ledgerline.session import freeze

#: Rows that a walk holds to look ahead in its range; further leads are looked up for all rows.
LOOK_AHEAD = 1_000_000
PID, RID = "_lw_pid", "_lw_rid"


def walked(df: DataFrame, keys: list[Column], walk: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]],
           extra: list[StructField], label: str) -> DataFrame:
    """``df`` sorted by ``keys``, each range passed through ``walk`` (which adds the ``extra`` columns), with its range
    ``PID`` and a number ``RID`` that grows with the order; written to the checkpoint folder."""
    rows = df.orderBy(*keys).mapInArrow(walk, StructType([*df.schema.fields, *extra]))
    return freeze(rows.withColumn(PID, F.spark_partition_id()).withColumn(RID, F.monotonically_increasing_id()), label)


def same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Row by row, whether two columns are alike as Spark's grouping has it: NULL is NULL, NaN is NaN."""
    equal = pc.fill_null(pc.equal(a, b), False)
    equal = pc.or_(equal, pc.and_(a.is_null(), b.is_null()))
    if pa.types.is_floating(a.type):
        equal = pc.or_(equal, pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False)))
    return equal.to_numpy(zero_copy_only=False)


def begins(column: pa.Array, last: pa.Array | None) -> np.ndarray:
    """Where a new value begins; ``last`` is the row before the first (one row long, or None)."""
    new = np.ones(len(column), bool)
    new[1:] = ~same(column[1:], column[:-1])
    if last is not None and len(column):
        new[0] = not same(column[:1], last)[0]
    return new


def since(new: np.ndarray, before: int) -> np.ndarray:
    """For each row the rows since the last beginning; the first rows go on from ``before`` of them."""
    at = np.arange(len(new))
    start = np.maximum.accumulate(np.where(new, at, -1))
    return np.where(start >= 0, at - start, at + before)


def look_ahead(batches, group: str, col: str, k: int, names: list[str]):
    """The batches with ``_i`` (place of the row in its group's rows of this range, from 0), ``_found`` and
    ``_value``: the value of ``col`` ``k`` rows on, if that row is of the group and in this range."""
    held, count, last, place = [], 0, None, 0

    def emit(rows: pa.RecordBatch, ready: int) -> pa.RecordBatch:
        g, v = rows.column(group), rows.column(col)
        inside = max(0, min(ready, rows.num_rows - k))
        found = same(g.slice(k, inside), g.slice(0, inside))
        value = pc.if_else(pa.array(found, pa.bool_()), v.slice(k, inside), pa.nulls(inside, v.type))
        rest = ready - inside
        out = rows.slice(0, ready)
        return pa.RecordBatch.from_arrays(
            [*out.columns, pa.concat_arrays([pa.array(found, pa.bool_()), pa.array([False] * rest, pa.bool_())]),
             pa.concat_arrays([value, pa.nulls(rest, v.type)])], [*names, "_i", "_found", "_value"])
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(group)
        i = since(begins(g, last), place)
        last, place = g.slice(len(g) - 1), int(i[-1]) + 1
        held.append(pa.RecordBatch.from_arrays([*b.columns, pa.array(i, pa.int64())], [*names, "_i"]))
        count += b.num_rows
        if count > 2 * k:
            rows = pa.concat_batches(held)
            yield emit(rows, count - k)
            held, count = [rows.slice(count - k)] if k else [], k
    if held:
        yield emit(pa.concat_batches(held), count)


def _ordered(name: str, ascending: bool, backwards: bool) -> Column:
    """NULLS LAST both ways; backwards is the exact reverse of that."""
    if backwards:
        return F.col(name).desc_nulls_first() if ascending else F.col(name).asc_nulls_first()
    return F.col(name).asc_nulls_last() if ascending else F.col(name).desc_nulls_last()


def cyclic_lead(df: DataFrame, group: str, order: list, col: str, k: int, out: str) -> DataFrame:
    """Add ``out``: ``col`` of the row ``k`` places on in the row's group under ``order`` (names, or ``(name, False)``
    for descending), counted round from the group's last row to its first.  ``k < 0`` looks back; any ``k`` is
    accepted, also beyond a range or a group.  Rows whose group is NULL are left out.  ``order`` should be a total
    order; rows alike in it are interchangeable."""
    names, backwards, k = df.columns, k < 0, abs(k)
    specs = [o if isinstance(o, tuple) else (o, True) for o in order]
    keys = [F.col(group).asc(), *[_ordered(*s, backwards) for s in specs]]
    reach = min(k, LOOK_AHEAD)
    extra = [StructField("_i", LongType()), StructField("_found", BooleanType()), StructField("_value", df.schema[col].dataType)]
    laid = walked(df.filter(F.col(group).isNotNull()), keys, lambda b: look_ahead(b, group, col, reach, names), extra, "lead")
    found = F.col("_found") & F.lit(reach == k)
    # places in the whole group, for the rows at the edges alone
    sizes = laid.groupBy(PID, group).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(PID).alias("_p"), F.col(group).alias("_g"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(whole).alias("_all"))

    def placed(rows: DataFrame) -> DataFrame:
        return (rows.join(sizes, (F.col(PID) == F.col("_p")) & (F.col(group) == F.col("_g")))
                .withColumn("_place", F.col("_before") + F.col("_i")))
    asking = placed(laid.filter(~found)).withColumn("_want", F.pmod(F.col("_place") + k, F.col("_all")))
    asked = placed(laid.filter(F.col("_i") < k) if reach == k else laid).select(F.col("_g").alias("_g2"), F.col("_place").alias("_place2"), F.col(col).alias("_v2"))
    elsewhere = asking.join(asked, (F.col(group) == F.col("_g2")) & (F.col("_want") == F.col("_place2")))
    at_hand = laid.filter(found).select(*names, F.col("_value").alias(out))
    return at_hand.unionByName(elsewhere.select(*names, F.col("_v2").alias(out)))


def count_values(batches, group: str, value: str, names: list[str]):
    """The batches with ``_d``: the number of distinct values of the group so far in this range."""
    last_group, last_value, so_far = None, None, 0
    for b in batches:
        if not b.num_rows:
            continue
        g, v = b.column(group), b.column(value)
        new_group = begins(g, last_group)
        new = new_group | begins(v, last_value)
        total = np.cumsum(new)
        # values counted before the group's first row in this batch
        base = np.maximum.accumulate(np.where(new_group, total - 1, -1))
        d = np.where(base >= 0, total - base, total + so_far)
        last_group, last_value, so_far = g.slice(len(g) - 1), v.slice(len(v) - 1), int(d[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d, pa.int64())], [*names, "_d"])


def dense_rank(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the dense rank of ``value``, largest first (NULL last), within ``group``; a NULL group is a group."""
    names = df.columns
    keys = [F.col(group).asc_nulls_last(), F.col(value).desc_nulls_last()]
    laid = walked(df, keys, lambda b: count_values(b, group, value, names), [StructField("_d", LongType())], "rank")
    edges = laid.groupBy(PID, group).agg(F.max("_d").alias("_n"), F.min_by(F.struct(value), RID).alias("_first"),
                                         F.max_by(F.struct(value), RID).alias("_last"))
    by_range = Window.partitionBy(group).orderBy(PID)
    goes_on = F.when(F.col("_first").eqNullSafe(F.lag("_last").over(by_range)), 1).otherwise(0)
    edges = edges.withColumn("_on", goes_on)
    before = F.sum(F.col("_n") - F.col("_on")).over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select(F.col(PID).alias("_p"), F.col(group).alias("_g"), (F.coalesce(before, F.lit(0)) - F.col("_on")).alias("_add"))
    return (laid.join(edges, (F.col(PID) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .select(*names, (F.col("_add") + F.col("_d")).alias(out)))
