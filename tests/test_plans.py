"""Plan-shape checks: the physical properties the operators are built for."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.operators.positions import ordered_position


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def q(spark, name):
    return plan(E.queries()[name](spark, SF_SMALL))


def test_top1_per_key_is_limited_before_the_shuffle(spark):
    p = q(spark, "dedup_first")
    first_limit = p.rfind("WindowGroupLimit")     # deepest = map side
    exchange = p.rfind("Exchange hashpartitioning")
    assert p.count("WindowGroupLimit") == 2 and first_limit > exchange


def test_calendars_have_no_cross_join(spark):
    for name in ("calendar_daily", "calendar_london", "timeline_monthly", "pivot_months"):
        p = q(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_pivot_is_one_aggregate_over_the_timeline(spark):
    p = q(spark, "pivot_months")
    assert "pivotfirst" not in p.lower()


def _left_joins_on_key(p):
    return [ln for ln in p.splitlines() if "LeftOuter" in ln and "[CustomerID" in ln]


def test_left_joins_read_each_side_once_and_carry_a_salt(spark):
    p = q(spark, "wide_extract")
    assert "LeftAnti" not in p and "Union" not in p
    assert len(_left_joins_on_key(p)) >= 2 and all("_salt" in ln for ln in _left_joins_on_key(p))


def test_median_needs_no_range_exchange(spark):
    from ledgerline.operators.selection import exact_median
    df = spark.range(100).select((F.col("id") * 1.5).alias("x"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.range(1).select(exact_median(df, "x")).explain()
    assert "Exchange" not in buf.getvalue()


def test_default_rates_need_no_roll_forward(spark):
    for name in ("type1_default_rate", "type2_default_rate", "type2_default_rate_year1"):
        assert "collect_list" not in q(spark, name)


def test_pair_counts_aggregate_before_join(spark):
    p = q(spark, "normalised_counts")
    # both join inputs are partial/final aggregates
    assert p.count("partial_count(1)") >= 2


def test_scan_reads_only_needed_columns(spark):
    p = q(spark, "category_counts")
    assert "ReadSchema: struct<p_type:string>" in p or "[p_type#" in p
    assert "p_name" not in p and "p_retailprice" not in p


def test_hot_group_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string"))
            .alias("g"), F.col("id").alias("o"))
        tagged = ordered_position(df, ["g"], ["o"])
        from ledgerline.functions.ordering import sort_spec
        laid = df.orderBy(*sort_spec(["g", "o"])).withColumn("pid", F.spark_partition_id())
        spread = laid.filter(F.col("g") == "hot").select("pid").distinct().count()
        assert spread >= 2      # a third of the rows never sits in a single range partition
        assert tagged.filter(F.col("g") == "hot").agg(F.max("pos")).first()[0] == 10000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_positions_balance_a_hot_user(spark):
    """One user holds a third of the events: the window (hash) layout gives
    that user's task >= 1/3 of the rows, the range scan spreads them."""
    from ledgerline.functions.ordering import sort_spec
    from ledgerline.operators.positions import window_position
    from ledgerline.sources import roles
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        e = roles.table(spark, SF_SMALL, "events").select("event_id", "ts", "user_id", "value")
        hot = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                           .otherwise(F.col("user_id")))
        total = hot.count()

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] / total
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert largest(hot.repartition(parts, "user_id")) >= 1 / 3
        assert largest(hot.orderBy(*sort_spec(["user_id", "ts", "event_id"]))) < 0.25
        a = ordered_position(hot, ["user_id"], ["ts", "event_id"], "pos")
        b = window_position(hot, ["user_id"], ["ts", "event_id"], "pos")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
