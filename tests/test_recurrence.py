"""The balance recurrence as a parallel prefix: ranges cut anywhere, one loan with a third of all rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerline.operators import loans as ln
from ledgerline.operators.recurrence import apply_map, carried, running_balance, walk, walk_range
from ledgerline.sources import roles

R = 0.1 / 12


def loop(opening, pays):
    out, b = [], opening
    for p in pays:
        out.append(b)
        new = math.nan if p is None or b is None else (b + b * R) - p
        b = new if new > 0 else 0.0
    return out


def made(rng, n_loans, longest, missing=0.05):
    """(key, opening, payments) of loans, some of which are paid off, some never."""
    out = []
    for key in range(n_loans):
        n = rng.randrange(1, longest)
        level = rng.choice([0.0, 5.0, 10.0, 100.0])
        pays = [None if rng.random() < missing else rng.choice([0.0, level, 2 * level]) for _ in range(n)]
        out.append((key, rng.choice([1000.0, 1200.0, 0.0, None]), pays))
    return out


def close(got, want):
    """Equal to a millionth of a cent, or to 11 digits."""
    return got == want or (got is not None and want is not None and abs(got - want) <= max(1e-8, 1e-11 * abs(want)))


@pytest.mark.parametrize("seed", range(30))
def test_any_cut_into_ranges_and_batches_equals_the_loop(seed):
    rng = random.Random(seed)
    loans = made(rng, rng.choice([1, 3, 40]), rng.choice([3, 30, 400]), rng.choice([0.0, 0.05]))
    flat = [(k, o, p) for k, o, pays in loans for p in pays]
    want = [b for _, o, pays in loans for b in loop(o, pays)]
    cuts = sorted({0, len(flat), *(rng.randrange(len(flat) + 1) for _ in range(rng.choice([0, 2, 12])))})
    got, ranges, parts = [], [], []
    for pid, (i, j) in enumerate(zip(cuts, cuts[1:])):
        inner = sorted({i, j, *(rng.randrange(i, j + 1) for _ in range(rng.choice([0, 3])))})
        batches = [pa.RecordBatch.from_pydict({"k": pa.array([f[0] for f in flat[a:b]], pa.int64()), "o": pa.array([f[1] for f in flat[a:b]], pa.float64()),
                                               "p": pa.array([f[2] for f in flat[a:b]], pa.float64())}) for a, b in zip(inner, inner[1:])]
        done = [r for b in walk_range(batches, "k", "o", "p", R, ["k", "o", "p"]) for r in b.to_pylist()]
        parts.append((pid, done))
        ranges.append({"pid": pid, "first": done[0]["k"], "last": done[-1]["k"], "tail": {**done[-1], "paid": done[-1]["p"]}})
    brought = dict(carried(ranges, R))
    for pid, done in parts:
        for r in done:
            goes_on = pid in brought and r["_a"] is not None
            got.append(apply_map(brought[pid], r["_a"], r["_x"], r["_m"]) if goes_on else r["_start"])
    assert len(got) == len(want) and all(map(close, got, want))


def test_one_range_has_the_numbers_of_the_loop():
    rng = random.Random(4)
    loans = made(rng, 50, 60)
    lengths = np.array([len(p) for *_, p in loans])
    paid = np.array([math.nan if p is None else p for *_, pays in loans for p in pays])
    opening = np.array([math.nan if o is None else o for _, o, _ in loans])
    before, after = walk(opening, np.cumsum(lengths) - lengths, lengths, paid, R)
    want = [math.nan if b is None else b for _, o, pays in loans for b in loop(o, pays)]
    assert np.array_equal(before, want, equal_nan=True)
    assert [float(a) for a in after] == [loop(o, [*pays, 0.0])[-1] for _, o, pays in loans]


def test_growth_beyond_all_numbers_leaves_no_nan():
    n = 200_000
    pays = [1.0] * n
    for opening in (1000.0, 10.0):
        batch = pa.RecordBatch.from_pydict({"k": pa.array([1] * n), "o": pa.array([opening] * n), "p": pa.array(pays)})
        (out,) = walk_range([batch], "k", "o", "p", R, ["k", "o", "p"])
        last = out.slice(n - 1).to_pylist()[0]
        assert last["_a"] == math.inf and not math.isnan(apply_map(opening, last["_a"], last["_x"], last["_m"]))
        assert apply_map(opening, last["_a"], last["_x"], last["_m"]) == (math.inf if opening > 500 else 0.0)


@pytest.fixture
def many_ranges(spark):
    """Ranges as they are on large data: small ones are not joined."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_loan_with_a_third_of_all_rows(many_ranges):
    spark = many_ranges
    rng = random.Random(9)
    loans = [(7, 5000.0, [rng.choice([0.0, 40.0, 60.0, None]) if rng.random() < 0.02 else 45.0 for _ in range(3000)])]
    loans += [(k + 100, o, p) for k, o, p in made(rng, 200, 60)]
    data = [(k, m, o, p) for k, o, pays in loans for m, p in enumerate(pays, 1)]
    df = spark.createDataFrame(data, "LoanID bigint, Month int, Opening double, Paid double").repartition(8)
    out = running_balance(df, "LoanID", ["Month"], "Opening", "Paid", R)
    got = {(r.LoanID, r.Month): r._start for r in out.collect()}
    want = {(k, m): b for k, o, pays in loans for m, b in enumerate(loop(o, pays), 1)}
    assert got.keys() == want.keys() and all(close(got[k], want[k]) for k in want)
    # the hot loan's months lie in several ranges, none of which is much larger than the others
    parts = [r["count"] for r in df.orderBy("LoanID", "Month").groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) >= 6 and max(parts) < 3 * sum(parts) / len(parts)


def test_prefix_equals_fold_on_the_registered_loans(many_ranges):
    scheduled, actual = roles.scheduled_and_actual(many_ranges, SF_SMALL)
    order = ["LoanID", "Month"]
    prefix, fold = (ln.loan_balances(scheduled, actual, method=m) for m in ("prefix", "fold"))
    assert prefix.schema == fold.schema
    assert rows(prefix.orderBy(*order)) == rows(fold.orderBy(*order))


def test_no_task_gathers_a_loan(spark):
    scheduled, actual = roles.scheduled_and_actual(spark, SF_SMALL)
    plan = ln.loan_balances(scheduled, actual)._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_empty_loans_and_strings_as_keys(spark):
    df = spark.createDataFrame([("b", 1, 100.0, 10.0), ("a", 1, 50.0, None), ("a", 2, 50.0, 5.0)], "k string, m int, o double, p double")
    got = sorted(rows(running_balance(df, "k", ["m"], "o", "p", 0.0)))
    assert [r[4] for r in got] == [50.0, 0.0, 100.0]
    assert running_balance(df.limit(0), "k", ["m"], "o", "p", 0.0).count() == 0
