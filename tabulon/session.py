"""Session construction and the shared folder used for lineage cuts and saved models."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tabulon",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Session with AQE, Arrow and a UTC clock.

    The master, the number of shuffle partitions and the driver's memory are set only
    where they are given; otherwise what spark-submit or the cluster's defaults say
    holds.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a private folder (tests and
    laptops); a cluster session without it is an error, because a machine-local
    folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) visible to every executor")
        # a core setting cannot be changed at runtime; the context's directory can
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder; ``unique`` appends a fresh id."""
    root = _checkpoint_root(spark)
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return posixpath.join(root, "tabulon", *tail)


def cut_lineage(df):
    """Reliable checkpoint (written to the shared folder) — survives executor loss."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, rows_a_file: int = 100_000):
    """``df`` written as Parquet to the shared folder and read from there, for rows that are read
    many times, a few columns each time; a checkpoint is read whole and not packed. So many
    rows a file that a table that comes from one task is read by several."""
    path = shared_path(df.sparkSession, "rows", unique=True)
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df):
    """``df``, its rows kept by the executors (memory, then disk) until the block ends; lost
    ones are computed again."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def spread(df, keys, partitions: int):
    """The rows dealt over a stated number of partitions by a hash of their key, each in
    key order, so that what is fitted on them depends neither on how many cores there
    are nor on the order in which tasks end.
    """
    cols = [f"`{k}`" for k in keys]
    return df.repartition(partitions, *cols).sortWithinPartitions(*cols)
