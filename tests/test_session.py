"""Scratch writes leave no shuffle files behind, and the session's settings as they were."""

from pyspark.sql import functions as F

from paygrid import session

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f and f.endswith(".data")}


def test_scratch_write_drops_its_shuffle_files(spark):
    """The readers of a written frame never read the exchanges behind it."""
    before = shuffle_files(spark)
    df = session.materialize(spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).count())
    assert df.count() == 1000 and df.agg(F.sum("count")).first()[0] == 20_000
    left = shuffle_files(spark) - before
    # The two aggregates above have one exchange each of four rows at most; the write dealt out 1000.
    assert all(len(open(f, "rb").read()) < 1000 for f in left)
    assert spark.conf.get(KEY) == "false" and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_a_session_keeps_its_own_setting(spark):
    spark.conf.set(KEY, "true")
    try:
        session.materialize(spark.range(5))
        assert spark.conf.get(KEY) == "true"
    finally:
        spark.conf.unset(KEY)
