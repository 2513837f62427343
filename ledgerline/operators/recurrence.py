"""The ordered recurrence of a loan's balance, without a state per loan.

A month maps the balance b to ``max(0, b + b*r - paid)``, a missing payment to 0.  Runs of months compose to maps of
one form, ``b -> max(m, a*(b - x))``: ``a`` is the growth over the run, ``x`` the payments discounted to its start, ``m``
where a balance of 0 ends up.  That form is closed under composition, so the months of one loan need not be
in one place:

1. A global sort by (loan, month) cuts the rows into ranges.  A loan with a third of all rows is cut like any
   other; its months are spread over many ranges.
2. Each range is walked once, in order, batch by batch.  Its first loan may have begun in an earlier
   range, so for that loan's rows the walk also records the map from the range's start to the row.
3. One row per range (its first and last loan and the map of its last) goes to the driver, which
   chains the maps: the balance that each range's first loan brings along.
4. Those balances, at most one per range, are joined back, and the recorded maps are applied.

The walk does the steps of a sequential loop, so a loan that lies in one range has the very numbers of that loop.  For
one that goes on from range to range the chained maps differ from it by at most about
``n * 2**-52 * (1 + r)**n * (opening + payments)`` with n its months in a range, which for 360 months is less than
a millionth of a cent.  The layout is written to the checkpoint folder, as ranges must not move
between steps 2 and 4."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerline.functions.ordering import sort_spec
from ledgerline.session import freeze

#: Runs walked side by side; fewer are walked one by one.
ABREAST = 16


def step(b: float, paid: float, rate: float) -> float:
    """The balance after one month."""
    new = (b + b * rate) - paid
    return new if new > 0 else 0.0


def walk(opening: np.ndarray, first: np.ndarray, length: np.ndarray, paid: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Balance before each row, and after each run's last row.  Run j has the rows ``first[j]`` to
    ``first[j] + length[j] - 1`` and starts from ``opening[j]``; NaN is a missing payment.

    Step k of all runs is one array operation, as long as many runs are that long."""
    before, after = np.empty(len(paid)), opening.astype(float)
    order = np.argsort(-length, kind="stable")
    live, k = len(order), 0
    lengths = length[order]
    while live >= ABREAST:
        own = order[:live]
        at = first[own] + k
        b = after[own]
        before[at] = b
        new = (b + b * rate) - paid[at]
        after[own] = np.where(new > 0, new, 0.0)
        k += 1
        live = int(np.searchsorted(-lengths, -k))
    for j in order[:live].tolist():
        b, rows = float(after[j]), slice(int(first[j]) + k, int(first[j] + length[j]))
        path = []
        for p in paid[rows].tolist():
            path.append(b)
            new = (b + b * rate) - p
            b = new if new > 0 else 0.0
        before[rows] = path
        after[j] = b
    return before, after


def walk_range(batches, key: str, opening: str, paid: str, rate: float, names: list[str]):
    """Step 2 for one range: the batches with ``_start`` and, for the rows of the first loan, ``_a, _x, _m``."""
    last, b, head = None, 0.0, None           # head: growth, discounted payments, balance from 0 of the first loan
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(key)
        pay = batch.column(paid).cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
        open_col = batch.column(opening).cast(pa.float64())
        amounts = open_col.fill_null(math.nan).to_numpy(zero_copy_only=False)
        new_run = np.ones(n, bool)
        new_run[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        goes_on = last is not None and keys[0].as_py() == last
        new_run[0] = not goes_on
        first = np.flatnonzero(new_run)
        if goes_on:
            first = np.concatenate([[0], first])
        length = np.diff(first, append=n)
        start_of = amounts[first]
        if goes_on:
            start_of[0] = b
        before, after = walk(start_of, first, length, pay, rate)
        missing = np.isnan(before) & open_col.is_null().to_numpy(zero_copy_only=False) & new_run
        a = x = m = None
        if head is None and last is None:
            head = (1.0, 0.0, 0.0)
        if head is not None:
            rows = int(length[0])
            own = pay[:rows]
            with np.errstate(over="ignore"):
                grown = head[0] * np.cumprod(np.full(rows, 1.0 + rate))
            grown[np.cumsum(np.isnan(own)) > 0] = 0.0     # after a missing payment nothing of the past is left
            with np.errstate(divide="ignore", invalid="ignore"):
                discounted = head[1] + np.cumsum(np.where(grown > 0, own / grown, 0.0))
            zero, end = walk(np.array([head[2]]), np.array([0]), np.array([rows]), own, rate)
            a, x, m = np.concatenate([[head[0]], grown[:-1]]), np.concatenate([[head[1]], discounted[:-1]]), zero
            head = (float(grown[-1]), float(discounted[-1]), float(end[0])) if rows == n else None
        columns = [pa.array(before, pa.float64(), mask=missing)]
        for values in (a, x, m):
            if values is None:
                columns.append(pa.nulls(n, pa.float64()))
            else:
                columns.append(pa.concat_arrays([pa.array(values, pa.float64()), pa.nulls(n - len(values), pa.float64())]))
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "_start", "_a", "_x", "_m"])
        last, b = keys[n - 1].as_py(), float(after[-1])


def apply_map(b, a, x, m):
    """``max(m, a*(b - x))``, for numbers; an overflowing ``a`` leaves no NaN."""
    return max(m, a * (b - x)) if b > x else m


def carried(ranges: list, rate: float) -> list[tuple[int, float]]:
    """Step 3: (range, balance that its first loan brings along) for the ranges whose first loan goes on."""
    out, previous, balance = [], None, 0.0
    for r in sorted(ranges, key=lambda r: r["pid"]):
        brought = None
        if previous is not None and r["first"] == previous:
            brought = balance
            out.append((r["pid"], balance))
        tail = r["tail"]
        start = tail["_start"]
        if brought is not None and tail["_a"] is not None:
            start = apply_map(brought, tail["_a"], tail["_x"], tail["_m"])
        paid = tail["paid"]
        previous = r["last"]
        balance = 0.0 if paid is None or start is None else step(start, paid, rate)
    return out


def running_balance(df: DataFrame, key: str, order: list, opening: str, paid: str, rate: float,
                    out: str = "_start") -> DataFrame:
    """Add ``out``: the balance before each row, for the rows of ``key`` in ``order`` (NULLS LAST; a total order
    but for interchangeable rows).  A key's first row starts from its ``opening``; a missing opening is a missing balance
    before that row and 0 after it.  Rows whose key is NULL are not accepted."""
    names = df.columns
    schema = StructType([*df.schema.fields, *[StructField(c, DoubleType()) for c in ("_start", "_a", "_x", "_m")]])
    walked = df.orderBy(*sort_spec([key, *order])).mapInArrow(
        lambda batches: walk_range(batches, key, opening, paid, rate, names), schema)
    laid = freeze(walked.withColumn("_pid", F.spark_partition_id()).withColumn("_rid", F.monotonically_increasing_id()), "balances")
    tail = F.struct("_start", "_a", "_x", "_m", F.col(paid).cast("double").alias("paid"))
    ranges = laid.groupBy(F.col("_pid").alias("pid")).agg(
        F.min_by(key, "_rid").alias("first"), F.max_by(key, "_rid").alias("last"), F.max_by(tail, "_rid").alias("tail")).collect()
    brought = df.sparkSession.createDataFrame(carried(ranges, rate), "_pid int, _brought double")
    b, a, x, m = (F.col(c) for c in ("_brought", "_a", "_x", "_m"))
    start = (F.when(b.isNull() | a.isNull(), F.col("_start"))
             .when(b > x, F.greatest(m, a * (b - x))).otherwise(m))
    return laid.join(brought, "_pid", "left").select(*names, start.alias(out))
