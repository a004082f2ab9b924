"""Session helpers: build a local session for tests/bench, find the checkpoint dir."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "paygrid") -> SparkSession:
    """Local session used by tests and the bench (a cluster passes its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, set as the checkpoint folder.

    Only a local master (tests) may leave it unset and gets a fresh scratch folder; elsewhere a
    driver-local folder would be invisible to the executors, so that is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="paygrid-ckpt-", dir=os.environ.get("PAYGRID_SCRATCH")))
    return sc.getCheckpointDir()


@contextmanager
def _setting(spark, key: str, value: str, default: str):
    """``key`` is ``value`` inside; a session that chose a value other than Spark's ``default`` keeps its own."""
    if spark.conf.get(key, default) != default:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def short_methods(spark):
    """Plans made inside fall back from generated stages that the JVM would interpret.

    The JVM compiles no method of more than 8000 bytes; Spark lets a stage have 65535, so a wide projection
    runs interpreted. With the lower limit Spark runs such a stage operator by operator, in short methods. A session
    that chose a limit of its own keeps it.
    """
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000", "65535")


def drop_shuffles(spark):
    """Jobs started inside delete their shuffle files when they end, not when the driver next collects garbage.

    Readers of a written frame read its files, never the exchanges behind it, so those files only fill the disks.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def materialize(df, name: str = "tmp"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but stays columnar, so readers of the
    written frame prune columns and push filters. Each call writes a new folder.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/paygrid-tmp/{name}-{uuid.uuid4().hex}"
    # zstd takes no more time than lz4 here and a fifth to a third less disk.
    with short_methods(spark), drop_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    _SCRATCH.append(path)
    # With the schema given, no job has to read it from the files.
    return spark.read.schema(df.schema).parquet(path)


# Scratch folders written by ``materialize`` in this process, oldest first.
_SCRATCH: list[str] = []


def scratch_mark() -> int:
    """Position to pass to ``release_scratch`` once the frames written after it are unused."""
    return len(_SCRATCH)


def release_scratch(spark, mark: int, keep_last: bool = False) -> None:
    """Delete the scratch folders written since ``mark`` (their frames must not be read again).

    ``keep_last`` spares the newest folder.
    """
    newest = _SCRATCH.pop() if keep_last and len(_SCRATCH) > mark else None
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_SCRATCH) > mark:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
    if newest:
        _SCRATCH.append(newest)
