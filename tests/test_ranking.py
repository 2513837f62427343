import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.operators import ranking as rk
from ledgerline.operators.positions import ordered_position, window_position

SHIFTS, RANKS = ["halo", "scan", "window"], ["walk", "scan", "window"]


@pytest.mark.parametrize("method", SHIFTS)
def test_cyclic_shift_two_ahead(spark, method):
    df = spark.createDataFrame([(i, a, "F") for i, a in enumerate([10, 20, 30, 40, 50], 1)]
                               + [(9, 7, "M")] + [(10, 10, "X"), (11, 20, "X")] + [(12, 1, None)],
                               "CustomerID int, Age int, Gender string")
    out = rows(rk.cyclic_shift(df, method=method))
    assert out == [(1, 10, 30, "F"), (2, 20, 40, "F"), (3, 30, 50, "F"), (4, 40, 10, "F"),
                   (5, 50, 20, "F"), (9, 7, 7, "M"), (10, 10, 10, "X"), (11, 20, 20, "X")]


@pytest.mark.parametrize("method", SHIFTS)
def test_cyclic_shift_inverse_is_identity(spark, method):
    rnd = random.Random(7)
    data = [(i, rnd.randint(1, 90), rnd.choice("AB")) for i in range(200)]
    df = spark.createDataFrame(data, "CustomerID int, Age int, Gender string").repartition(7)
    fwd = rk.cyclic_shift(df, k=3, method=method).select(
        "CustomerID", F.col("CorrectedAge").alias("Age"), "Gender")
    back = rk.cyclic_shift(fwd, k=-3, method=method)
    assert sorted((r[0], r[2]) for r in rows(back)) == sorted((d[0], d[1]) for d in data)


@pytest.mark.parametrize("method", RANKS)
def test_dense_rank_without_gaps(spark, method):
    corrected = spark.createDataFrame([(1, 40, 40, "F"), (2, 40, 41, "F"), (3, 40, 42, "M"),
                                       (4, 40, 43, "M"), (5, None, None, "M")],
                                      "CustomerID int, Age int, CorrectedAge int, Gender string")
    reps = spark.createDataFrame([(1, 9), (2, 5), (3, 5)], "CustomerID int, Amount int")
    out = rows(rk.rank_in_category(corrected, reps, method=method), "CustomerID", "AgeCategory", "Rank")
    assert sorted(out, key=lambda r: r[0]) == [(1, "Adult", 1), (2, "Adult", 2), (3, "Adult", 2),
                                              (4, "Adult", 3), (5, None, 1)]


def test_ordered_position_equals_window_under_skew(spark):
    rnd = random.Random(3)
    # one group holds about a third of the rows, many small groups, NULL group included
    data = [("hot" if rnd.random() < 0.33 else rnd.choice(["a", "b", "c", None]),
             rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, o int, t int").repartition(11)
    a = ordered_position(df, ["g"], ["o", "t"], "pos", "n")
    b = window_position(df, ["g"], ["o", "t"], "pos", "n")
    assert sorted(rows(a), key=repr) == sorted(rows(b), key=repr)


def test_ordered_position_without_group(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    out = rows(ordered_position(df, [], ["v"], "pos"), "v", "pos")
    assert sorted(out) == [(i, i + 1) for i in range(1000)]


def test_exact_median_with_heavy_repeats(spark):
    import numpy as np
    from ledgerline.operators.selection import exact_median
    rnd = random.Random(9)
    for n in (1, 2, 7, 1000, 1001):
        vals = [5.0 if rnd.random() < 0.4 else float(rnd.randint(0, 30)) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "x double")
        got = spark.range(1).select(exact_median(df.repartition(4), "x")).first()[0]
        assert got == float(np.median(vals)), n


def test_cumulative_weight_scan_equals_window(spark):
    from ledgerline.operators.positions import cumulative_weight
    df = spark.createDataFrame([(i, (i * 7) % 5 + 1) for i in range(500)], "k int, w int").repartition(6)
    a = rows(cumulative_weight(df, ["k"], "w", "c"), "k", "c")
    b = rows(df.withColumn("c", F.sum("w").over(Window.orderBy("k"))), "k", "c")
    assert sorted(a) == sorted(b)
