from conftest import rows
from ledgerline.operators.joins import left_join


def test_left_join_matches_builtin_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")],
                                 "k int, l string")
    # key 1 is "hot" on the right side
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (None, 9)],
                                  "k int, r int")
    want = left.join(right, "k", "left")
    for method in ("salted", "split", "plain"):
        got = left_join(left, right, "k", method)
        assert got.columns == want.columns
        assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
        assert len(rows(got)) == 2 * 50 + 1 + 1 + 1


def test_left_join_split_form_can_be_split(spark):
    import contextlib
    import io
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 0)], "k int, r int")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        left_join(left, right, "k", "split").explain()
    assert "LeftAnti" in buf.getvalue()


def test_heavy_keys_are_found_with_their_shares(spark):
    from pyspark.sql import functions as F
    from ledgerline.operators.joins import heavy_keys
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k")).repartition(6)
    found = spark.range(1).select(heavy_keys(df, ["k"], 12)).first()[0]
    assert set(found) == {7} and 4 <= found[7] <= 5
    none = spark.range(1).select(heavy_keys(df.filter("k < 0"), ["k"], 12)).first()[0]
    assert not none


def test_hot_right_key_is_dealt_out_without_losing_rows(spark):
    from pyspark.sql import functions as F
    left = spark.range(400).select((F.col("id") % 50).alias("k"), F.col("id").alias("l"))
    # a third of the right rows is key 7, most of them equal rows; keys 100.. find no partner on the left
    right = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 211).alias("k"),
                                     (F.col("id") % 2).alias("r")).repartition(8)
    got, want = left_join(left, right, "k", shares=8), left.join(right, "k", "left")
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = left_join(left, right, "k", shares=8).filter("k = 7").groupBy(F.spark_partition_id()).count().count()
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_with_several_keys_nulls_and_clashing_names(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", None, 11), ("b", 2, 12), (None, 3, 13)], "s string, n int, _salt int")
    right = spark.createDataFrame([("a", 1, i) for i in range(20)] + [("b", None, 5)], "s string, n int, _there int")
    got, want = left_join(left, right, ["s", "n"], shares=2), left.join(right, ["s", "n"], "left")
    assert got.columns == want.columns
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
    empty = right.limit(0)
    assert sorted(rows(left_join(left, empty, ["s", "n"])), key=repr) == sorted(rows(left.join(empty, ["s", "n"], "left")), key=repr)


def test_keys_of_other_types_take_the_split_form(spark):
    left = spark.createDataFrame([(0.0, 1), (2.0, 2)], "k double, l int")
    right = spark.createDataFrame([(-0.0, 5)] * 9 + [(3.0, 6)], "k double, r int")
    assert sorted(rows(left_join(left, right, "k"), "l", "r"), key=repr) == sorted([(1, 5)] * 9 + [(2, None)], key=repr)
