"""The chunked scan: windows, pushed filters, rows without a period."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paygrid.sources import chunks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("chunks") / "src")
    day = F.date_add(F.lit(dt.date(2020, 1, 10)), (F.col("id") * 7 % 700).cast("int"))
    df = spark.range(2000).select("id", F.when(F.col("id") % 97 != 0, day).alias("dia"), F.lit("x").alias("texto"))
    df.repartition(3).write.parquet(path)
    chunks.register(spark)
    return path


def scan(spark, folder, **options):
    return spark.read.format(chunks.FORMAT).options(path=folder, column="dia", **options).load()


def test_windows_are_disjoint_and_complete():
    for months in (1, 2, 5, 12):
        w = chunks.month_windows(dt.date(2019, 11, 30), dt.date(2021, 2, 1), months)
        assert w[0].lo == dt.date(2019, 11, 1) and w[-1].hi > dt.date(2021, 2, 1)
        assert all(a.hi == b.lo for a, b in zip(w, w[1:])) and all(x.lo < x.hi and x.lo.day == 1 for x in w)
    with pytest.raises(ValueError):
        chunks.month_windows(dt.date(2020, 1, 1), dt.date(2020, 1, 1), 0)


def test_all_rows_once(spark, folder):
    plain = spark.read.parquet(folder)
    for months in ("1", "5"):
        got = scan(spark, folder, months=months)
        assert got.schema == plain.schema
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_task_reads_one_window(spark, folder):
    seen = scan(spark, folder).withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.count_distinct(F.trunc("dia", "MM")).alias("months"), F.count_distinct(F.col("dia").isNull()).alias("kinds")).collect()
    assert all(r.months <= 1 and r.kinds == 1 for r in seen) and len(seen) == 25       # 24 months and the rows without a day


@pytest.mark.parametrize("pred,n", [
    ("dia >= date'2020-05-01' and dia < date'2020-06-01'", 1), ("dia = date'2020-05-17'", 1), ("dia is null", 1),
    ("dia > date'2021-11-15'", 2), ("dia < date'2020-03-01'", 2), ("dia <= date'2020-03-01'", 3),
    ("dia in (date'2020-02-03', date'2020-04-05')", 3), ("dia >= date'2030-01-01'", 1), ("dia is not null", 24), ("id < 5", 25)])
def test_filters_leave_the_windows_they_touch(spark, folder, pred, n):
    got = scan(spark, folder).filter(pred)
    plain = spark.read.parquet(folder).filter(pred)
    assert got.rdd.getNumPartitions() == n          # without any window Spark makes one empty task
    assert sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in plain.collect())


def test_empty_source_and_bad_column(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.range(0).select("id", F.lit(None).cast("date").alias("dia")).write.parquet(path)
    chunks.register(spark)
    assert scan(spark, path).count() == 0
    with pytest.raises(Exception, match="no column"):
        spark.read.format(chunks.FORMAT).options(path=path, column="nada").load().count()
