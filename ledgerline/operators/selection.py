"""Exact order statistics by selection: no sort, no exchange of the values.

A double has an unsigned 64-bit number that orders as it does.  The values are read a few times; each pass counts, in
every task, how many of them have each value of the next 16 bits, among those that agree with the wanted ranks
in the bits before.  The counts are added up by Spark; at most 65,536 for each wanted rank reach the driver, which
picks the digit that holds the rank.  A pass also keeps the least and greatest value of each digit: where
they are equal the value is found.  Amounts rarely need more than two passes, no data need more than four.

A value that a third of the rows have is one count per task.  The column is written to the checkpoint folder
first, so that its rows are not made anew for each pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import freeze

DIGIT = 16                                  # bits that a pass looks at
SIGN = np.uint64(1 << 63)
_COUNTS = "prefix int, digit int, n bigint, low bigint, high bigint"


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Numbers (uint64) in the order of the doubles; -0.0 is 0.0."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def value_of(number: int) -> float:
    """The double of a number of :func:`ordered_bits`."""
    bits = number & ~(1 << 63) if number >> 63 else ~number & (1 << 64) - 1
    return float(np.uint64(bits).view(np.float64))


def count_digits(batches, prefixes: list[int], shift: int):
    """How many values behind each prefix have each digit at ``shift``, with the least and the greatest of them."""
    size = 1 << DIGIT
    n = np.zeros((len(prefixes), size), np.int64)
    low, high = np.full(n.shape, np.iinfo(np.int64).max), np.full(n.shape, np.iinfo(np.int64).min)
    for b in batches:
        bits = ordered_bits(b.column(0).to_numpy(zero_copy_only=False))
        for j, prefix in enumerate(prefixes):
            own = bits if shift + DIGIT == 64 else bits[bits >> np.uint64(shift + DIGIT) == np.uint64(prefix)]
            digit = (own >> np.uint64(shift) & np.uint64(size - 1)).astype(np.int64)
            n[j] += np.bincount(digit, minlength=size)
            signed = (own ^ SIGN).view(np.int64)
            np.minimum.at(low[j], digit, signed)
            np.maximum.at(high[j], digit, signed)
    at, digit = np.nonzero(n)
    yield pa.RecordBatch.from_pydict({
        "prefix": pa.array(at, pa.int32()), "digit": pa.array(digit, pa.int32()), "n": pa.array(n[at, digit]),
        "low": pa.array(low[at, digit]), "high": pa.array(high[at, digit])})


def order_statistics(df: DataFrame, col: str, ranks: Callable[[int], Sequence[int]]) -> list[float]:
    """The values of ``col`` at the ranks (from 1) that ``ranks`` gives for the number of values; NULL and NaN
    don't count.  ``ranks`` is asked once; no values, no ranks."""
    v = F.col("v")
    values = freeze(df.select(F.col(col).cast("double").alias("v")).filter(v.isNotNull() & ~F.isnan(v)), "values")
    found: dict[int, float] = {}
    wanted: list[int] | None = None
    search: dict[int, list[tuple[int, int]]] = {0: []}      # prefix -> (place in ``wanted``, rank behind the prefix)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefixes = sorted(search)
        counts = values.mapInArrow(lambda b, p=prefixes, s=shift: count_digits(b, p, s), _COUNTS)
        table = (counts.groupBy("prefix", "digit").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
                 .toArrow().sort_by([("prefix", "ascending"), ("digit", "ascending")]))
        at, digit, n, low, high = (table[c].to_numpy() for c in table.column_names)
        if wanted is None:
            total = int(n.sum())
            wanted = list(ranks(total)) if total else []
            search = {0: list(enumerate(wanted))}
        following: dict[int, list[tuple[int, int]]] = {}
        for j, prefix in enumerate(prefixes):
            own = slice(*np.searchsorted(at, [j, j + 1]))
            upto = np.cumsum(n[own])
            for place, rank in search[prefix]:
                i = int(np.searchsorted(upto, rank))
                least, greatest = int(low[own][i]), int(high[own][i])
                if least == greatest:
                    found[place] = value_of(least + (1 << 63))
                else:
                    behind = rank - (int(upto[i - 1]) if i else 0)
                    following.setdefault(prefix << DIGIT | int(digit[own][i]), []).append((place, behind))
        search = following
        if not search:
            break
    return [found[i] for i in range(len(wanted or []))]


def exact_median(df: DataFrame, col: str) -> Column:
    """Exact median of ``col`` (NULL and NaN skipped; mean of the two middle values for an even count, as pandas),
    as a literal: the selection runs when this is called.  NULL without values."""
    middle = order_statistics(df, col, lambda n: sorted({(n + 1) // 2, n // 2 + 1}))
    return F.lit((middle[0] + middle[-1]) / 2.0 if middle else None).cast("double")
