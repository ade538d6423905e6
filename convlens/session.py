"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "convlens") -> SparkSession:
    """A session tuned for this workload.

    AQE re-plans joins (broadcast only when the runtime size is under the
    threshold), coalesces small shuffle partitions and splits skewed ones.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(8, 2 * cpus)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CONVLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced. Only
    when it is unset on a local master (tests) a private folder is created and
    registered; elsewhere executors could not share such a folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="convlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    _MADE.append(f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: for tables that several passes read, each of them few columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Removes what ``scratch_path`` named in this process, through the file system of the folder; for the end of a run, when no
    result that reads it is wanted any more. Returns how many folders there were."""
    paths, gone = spark.sparkContext._jvm.org.apache.hadoop.fs, 0
    while _MADE:
        path = paths.Path(_MADE.pop())
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def cut_lineage(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    checkpoint_root(spark)
    return df.checkpoint(eager=True)


def part_count(spark: SparkSession, rows: int, least: int = 25_000, most: int = 1_000_000) -> int:
    """One part for ``least`` rows, up to as many as cores; then a multiple of the cores with about ``most`` rows or fewer each."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // least) if rows <= least * cores else cores * -(-rows // (cores * most)))


def even(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by the hash of ``key`` into parts of like size: learners pass over their rows many times and wait for the largest part each time."""
    return df.repartition(part_count(df.sparkSession, df.count()), key)
