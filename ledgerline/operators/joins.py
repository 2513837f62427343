"""Join shapes of the reference (J1-J10) where Spark needs help at scale.

A LEFT join keeps every left row and attaches all matching right rows.  When
one key holds a large share of the *right* rows, the join partition of that
key lands in one task, and AQE cannot split it: only the preserved (left)
side of an outer join may be split.  :func:`left_join` therefore splits such keys itself:

1. A mergeable sketch of frequent items (Spark's ``approx_top_k_*``, of bounded size, merged in two
   steps) runs over the right side's keys alone.  It finds every key with more rows than a
   partition's share; a key that it reports besides costs a little, never a wrong row.
2. Right rows of a heavy key are dealt out over as many salts as the key has shares; by the content of the row and
   its input partition, so equal rows part and a retried task deals alike.
3. Left rows of a heavy key are copied once per salt, all others stay single, and one LEFT join on
   (key, salt) follows.  A heavy key has right rows, so a copy without a match is dropped.

Both sides are read once by the join; the sketch reads the key column.  Rows with a NULL key find no
partner and come out once, NULL-padded, exactly as in a LEFT join.  Nothing is decided on the driver: the heavy
keys are a scalar subquery of the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, IntegerType, LongType, MapType, ShortType, StringType, TimestampType, VariantType,
)

#: Most shares that the rows are counted in, and the keys that a sketch follows: its error is about 3.5 / TRACKED of
#: all rows, a fifth of the smallest share.
SHARES, TRACKED = 1024, 16384
#: Tasks that merge the partitions' sketches before the last one does.
MERGERS = 64
_WHOLE = (ByteType, ShortType, IntegerType, LongType, StringType, DateType, TimestampType)


def left_join(left: DataFrame, right: DataFrame, on: list[str] | str,
              method: str = "salted", shares: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (on)``; ``method`` is ``"salted"`` (heavy keys of the right side
    dealt out), ``"split"`` (inner join plus anti join, which AQE can split but which reads the left side
    twice) or ``"plain"``.

    ``shares``: a key is heavy beyond one of so many shares of the right rows (default: the
    session's shuffle partitions, at most ``SHARES``).  Keys that aren't whole numbers, text, dates or
    times of the same type on both sides take ``"split"``: equality of their text or of their sketch would not
    be that of the join.

    Output columns: the ``on`` columns, then left's other columns, then
    right's other columns (the order of ``DataFrame.join(..., "left")``)."""
    on = [on] if isinstance(on, str) else list(on)
    if method == "plain":
        return left.join(right, on, "left")
    if method == "split" or method == "salted" and not _sketchable(left, right, on):
        return _split(left, right, on)
    if method != "salted":
        raise ValueError(f"unknown method {method!r}")
    return _salted(left, right, on, shares)


def _split(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    matched = left.join(right, on, "inner")
    keys = right.select(*on).distinct()
    unmatched = left.join(keys, on, "left_anti")
    right_types = {f.name: f.dataType for f in right.schema.fields}
    pad = [F.lit(None).cast(right_types[c]).alias(c) for c in right.columns if c not in on]
    unmatched = unmatched.select(*matched.columns[:len(left.columns)], *pad)
    return matched.unionByName(unmatched)


def _type(df: DataFrame, name: str) -> DataType:
    return df.select(name).schema.fields[0].dataType


def _sketchable(left: DataFrame, right: DataFrame, on: list[str]) -> bool:
    """Keys of one kind on both sides, whose equality is that of their text."""
    types = [(_type(left, c), _type(right, c)) for c in on]
    return all(a == b and isinstance(a, _WHOLE) and (not isinstance(a, StringType) or a == StringType()) for a, b in types)


def _item(on: list[str]) -> Column:
    """The key as one value; NULL if a part of it is."""
    if len(on) == 1:
        return F.col(on[0])
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    return F.when(~missing, F.to_json(F.struct(*on)))


def heavy_keys(df: DataFrame, on: list[str], shares: int) -> Column:
    """A map from every key with more than one of ``shares`` shares of the rows to the number of shares that it
    holds, as a scalar subquery; from the sketch, so lighter keys near that bound may be in it too."""
    keys = df.select(_item(on).alias("k")).filter(F.col("k").isNotNull())
    parts = keys.groupBy((F.spark_partition_id() % MERGERS).alias("p")).agg(
        F.expr(f"approx_top_k_accumulate(k, {TRACKED})").alias("s"), F.count(F.lit(1)).alias("n"))
    # by a constant: no rows, no sketch to combine
    whole = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s"), F.sum("n").alias("n"))
    found = whole.select(F.expr(f"approx_top_k_estimate(s, {shares})").alias("e"), "n")
    heavy = F.filter("e", lambda x: x["item"].isNotNull() & (x["count"] * F.lit(shares) > F.col("n")))
    entries = F.transform(heavy, lambda x: F.struct(x["item"], F.ceil(x["count"] * F.lit(shares) / F.col("n")).cast("int")))
    return found.select(F.map_from_entries(entries)).scalar()


def _spare(base: str, *frames: DataFrame) -> str:
    """A column name that no frame has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base in taken:
        base += "_"
    return base


def _salted(left: DataFrame, right: DataFrame, on: list[str], shares: int | None) -> DataFrame:
    spark = left.sparkSession
    shares = max(2, min(shares or int(spark.conf.get("spark.sql.shuffle.partitions")), SHARES))
    salt, split, there = (_spare(n, left, right) for n in ("_salt", "_split", "_there"))
    heavy = heavy_keys(right, on, shares)
    salts = F.try_element_at(heavy, _item(on))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(split), F.lit(1)) - 1))
    spread = left.withColumn(split, salts).withColumn(salt, copies)
    content = [F.col(f"`{f.name}`") for f in right.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    own = F.pmod(F.xxhash64(*content, F.spark_partition_id()), salts).cast("int")
    dealt = right.withColumn(salt, F.coalesce(own, F.lit(0))).withColumn(there, F.lit(True))
    joined = spread.join(dealt, [*on, salt], "left").filter(F.col(split).isNull() | F.col(there).isNotNull())
    return joined.drop(salt, split, there)
