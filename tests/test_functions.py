"""Micro fixtures for the scalar rules (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from raincheck.functions import (day_of_week, exact_avg, null_if_token, rain_flag,
                                 store_size_tier, temperature_range, weather_label)
from raincheck.functions.nulls import NULL_TOKENS
from raincheck.sources.payloads import weather_file_name


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_store_size_tier_else_takes_null(spark):
    df = spark.createDataFrame([(7,), (8,), (9,), (10,), (None,)], "n int")
    got = col_values(df.orderBy(F.col("n").asc_nulls_last()), store_size_tier("n"))
    assert got == ["Small", "Medium", "Medium", "Large", "Large"]


def test_rain_flag_strict_and_null_is_dry(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.1), (4, None)], "k int, p double")
    assert col_values(df.orderBy("k"), rain_flag("p")) == [False, False, True, False]


def test_temperature_range_inclusive_moderate_and_null_hot(spark):
    df = spark.createDataFrame(
        [(1, Decimal("9.99")), (2, Decimal("10.00")), (3, Decimal("25.00")), (4, Decimal("25.01")), (5, None)],
        "k int, t decimal(5,2)")
    assert col_values(df.orderBy("k"), temperature_range("t")) == ["cold", "moderate", "moderate", "hot", "hot"]


def test_weather_label_groups_false_and_null_apart(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "r boolean")
    g = df.groupBy("r").count().select(weather_label("r").alias("l"))
    assert sorted(col_values(g, "l")) == ["Not Rainy", "Not Rainy", "Rainy"]


def test_invoice_total_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "3.5"), (3, "-2.5"), (4, "2.49")], "k int, v string")
    got = col_values(df.orderBy("k"), F.col("v").cast("decimal(10,0)"))
    assert got == [Decimal(3), Decimal(4), Decimal(-3), Decimal(2)]


def test_exact_avg_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("9.49"),), (Decimal("9.50"),)], "t decimal(5,2)")
    assert df.agg(exact_avg("t", "decimal(5,2)")).first()[0] == Decimal("9.50")
    df = spark.createDataFrame([(Decimal("1.00"),), (None,), (Decimal("3.00"),)], "t decimal(5,2)")
    assert df.agg(exact_avg("t", "decimal(5,2)")).first()[0] == Decimal("2.00")


def test_day_of_week_zero_is_sunday(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 5),), (dt.date(2025, 1, 11),)], "d date")
    assert col_values(df.orderBy("d"), day_of_week("d")) == [0, 6]


def test_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    r = df.select(F.weekofyear("d"), F.year("d")).first()
    assert (r[0], r[1]) == (53, 2021)


def test_null_tokens(spark):
    df = spark.createDataFrame([(t,) for t in ["", "NA", "N/A", "null", "None", "nan", "x"]], "v string")
    got = col_values(df, null_if_token("v"))
    assert got == [None] * 6 + ["x"]
    assert "NA" in NULL_TOKENS and "nan" in NULL_TOKENS


def test_weather_file_name_is_previous_day():
    assert weather_file_name(dt.date(2025, 3, 1)) == "2025-02-28"


def test_scale_conf_sizes_partitions():
    from raincheck.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    assert scale_conf(1, 8)["spark.sql.shuffle.partitions"] == "24"


def test_shared_dir_uses_session_setting_or_one_local_folder():
    from raincheck import session

    class Ctx:
        applicationId, master = "app-x", "local[2]"
        def __init__(self): self.dir = None
        def getCheckpointDir(self): return self.dir
        def setCheckpointDir(self, d): self.dir = d + "/uuid"

    class Conf:
        def __init__(self, v): self.v = v
        def get(self, k, default=None): return self.v if k == "spark.checkpoint.dir" else default

    class Spark:
        def __init__(self, v): self.conf, self.sparkContext = Conf(v), Ctx()

    assert session.shared_dir(Spark("hdfs://nn/ckpt/")) == "hdfs://nn/ckpt"
    local = Spark(None)
    first = session.shared_dir(local)
    assert local.sparkContext.dir.startswith(first)
    assert session.shared_dir(local).startswith(first)
