"""Session defaults and the one place that decides where scratch data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keeps the state of streams on local disk (and in the checkpoint), not on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "crawlframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Adaptive execution splits skewed joins and coalesces small partitions; all
    stored timestamps are UTC.  Keyword settings override (``__`` reads as a dot).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only where none is named, and only in local mode, a temporary one is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="crawlframe-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under :func:`checkpoint_root`; nothing exists there yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """Give a plain scan an even share of rows for every core.

    For tables that feed Python workers.  A scan may have many partitions and
    its rows in few of them, as a row group of a file is read by one task
    whatever its size.  Rows are counted by partition, from the footers alone;
    where one holds more than twice a core's share all are spread by the unique
    ``key``, else the table is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counted = df.groupBy(F.spark_partition_id().alias("part")).count()
    most, total = counted.agg(F.max("count"), F.sum("count")).first()
    if not total or most * cores <= 2 * total:
        return df
    return df.repartition(max(cores, df.rdd.getNumPartitions()), key)
