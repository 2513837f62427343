import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import (
    age_category, asc, clip, desc, half_even, normalise_province, sql_int, to_zone, try_double,
    try_int,
)
from ledgerline.operators.summaries import guarded_percent


def one_col(spark, values, type_):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def test_try_int_rounds_text_and_nulls_bad_values(spark):
    df = one_col(spark, [" 12 ", "abc", "1863.84", None, "2.5", "-2.5"], "string")
    assert [r[0] for r in df.select(try_int("x")).collect()] == [12, None, 1864, None, 3, -3]


def test_try_double_of_float_goes_through_text(spark):
    df = one_col(spark, [4.88], "float")
    assert df.select(try_double("x")).first()[0] == 4.88


def test_sql_int_rounds_half_to_even(spark):
    df = one_col(spark, [2.5, 3.5, -2.5, 2.7], "double")
    assert [r[0] for r in df.select(sql_int("x")).collect()] == [2, 4, -2, 3]


def test_half_even_matches_numpy_not_sql_round(spark):
    import numpy as np
    values = [0.125, 2.675, 1.005, 2.345, -0.125, 1234.565, 0.0]
    df = one_col(spark, values, "double")
    got = df.select(half_even("x", 2).alias("e"), F.round("x", 2).alias("r")).collect()
    assert [r.e for r in got] == [float(np.round(v, 2)) for v in values]
    assert (got[0].e, got[0].r) == (0.12, 0.13)
    assert (got[2].e, got[2].r) == (1.0, 1.01)


def test_clip_keeps_null(spark):
    df = one_col(spark, [None, -1.0, 3.0], "double")
    assert [r[0] for r in df.select(clip("x", lower=0)).collect()] == [None, 0.0, 3.0]
    df2 = one_col(spark, [-1.0, 0.5, 7.0], "double")
    assert [r[0] for r in df2.select(clip("x", 0, 1)).collect()] == [0.0, 0.5, 1.0]


def test_nulls_last_both_directions(spark):
    df = one_col(spark, [1, None, 2], "int")
    assert [r[0] for r in df.orderBy(asc("x")).collect()] == [1, 2, None]
    assert [r[0] for r in df.orderBy(desc("x")).collect()] == [2, 1, None]


def test_guarded_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, n int")
    got = [r[0] for r in df.select(guarded_percent(F.col("a"), F.col("n"))).collect()]
    assert got == [33.33, None]


def test_province_normaliser(spark):
    df = one_col(spark, [" kzn ", "KwaZulu Natal", "LP", "Xyz ", None, "EASTERNCAPE", "gp"], "string")
    got = [r[0] for r in df.select(normalise_province("x")).collect()]
    assert got == ["KwaZulu-Natal", "KwaZulu-Natal", "Limpopo", "Xyz", None, "EASTERNCAPE", "gp"]


def test_age_category_bounds(spark):
    df = one_col(spark, [19, 20, 29, 30, 59, 60, None], "int")
    got = [r[0] for r in df.select(age_category("x")).collect()]
    assert got == ["Teen", "Young Adult", "Young Adult", "Adult", "Adult", "Pensioner", None]


def test_zone_conversion_to_london(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 7, 1, 7, 30), "America/New_York"),
         (dt.datetime(2024, 7, 1, 7, 30), "BST"),
         (dt.datetime(2024, 1, 1, 7, 30), "EST")],
        "ts timestamp_ntz, z string")
    got = [r[0] for r in df.select(to_zone("ts", F.col("z"))).collect()]
    assert got == [dt.datetime(2024, 7, 1, 12, 30), dt.datetime(2024, 7, 1, 7, 30),
                   dt.datetime(2024, 1, 1, 12, 30)]


def test_cluster_conf_sizes_partitions():
    from ledgerline.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2) + 1
    assert int(cluster_conf(10, 8)["spark.sql.shuffle.partitions"]) == 24


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_checkpoint_folder_policy():
    import pytest
    from ledgerline.session import ensure_checkpoint_dir
    configured = _Session(_Context("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///ckpt"}))
    assert ensure_checkpoint_dir(configured) == "hdfs:///ckpt"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(_Context("yarn", {})))
    local = _Session(_Context("local[4]", {}))
    path = ensure_checkpoint_dir(local)
    assert "ledgerline-ckpt-" in path
    already = _Session(_Context("yarn", {}, current="hdfs:///shared/ckpt"))
    assert ensure_checkpoint_dir(already) == "hdfs:///shared/ckpt"
