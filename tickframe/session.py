"""SparkSession construction and shared-storage helpers.

On a cluster the session is built by the launcher; these helpers only add
what the jobs need (UTC session zone, AQE) and never replace settings the
cluster already made.  Lineage is cut with ``checkpoint()`` into the folder
named by ``spark.checkpoint.dir``; a local folder is only chosen when that
setting is unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CODEGEN_CACHE_ENTRIES = 2000
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tickframe") -> SparkSession:
    """Local session for tests and the bench; cluster jobs reuse the active one."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # The indicator job generates ~140 classes; with the default cache of
        # 100 every run recompiles them and the JIT starts cold (static conf:
        # on a cluster it belongs in the executors' configuration).
        .config("spark.sql.codegen.cache.maxEntries", str(CODEGEN_CACHE_ENTRIES))
        # plans show whole filters, also those of columns with long ids
        .config("spark.sql.maxMetadataStringLength", "1000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Sets what the jobs rely on where the session leaves it unset.

    ``hugeMethodLimit`` 8000 matches the JVM's own limit for JIT compilation:
    the indicator stages generate large fused methods, and a method above
    8000 bytes of bytecode would run interpreted.  Above the limit Spark
    falls back to per-operator code split into small, compiled methods.
    The indicator table is 94 columns of doubles, which snappy (Spark's
    default) hardly shrinks; zstd takes about a fifth less.
    """
    given = spark.conf.getAll
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.codegen.hugeMethodLimit", "8000"),
                       ("spark.sql.parquet.compression.codec", "zstd")):
        if key not in given:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, the bench) may fall back to a
    temporary folder; on a cluster the setting must name shared storage.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder before running these jobs")
        path = tempfile.mkdtemp(prefix="tickframe-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside deletes its shuffle files when it ends, not when the driver's JVM next collects garbage.

    For a checkpoint or a write whose plan nobody runs again.  A DataFrame keeps the mode it was made under: one that was
    made before has to be made anew (``df.select("*")``).
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
