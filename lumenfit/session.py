"""Session helpers: a local session for tests and the lineage cut used by iterative plans."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = 8, app: str = "lumenfit", **conf: str) -> SparkSession:
    """A small single-machine session; a cluster session is configured by its operator instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("LUMENFIT_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Where that is unset a session of one machine, as in tests, uses a folder of its warehouse; on a cluster the warehouse
    may be a folder of one machine, so the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lumenfit-shared"


class Scratch:
    """Owner of intermediate tables: those that :func:`durable` writes inside the ``with`` block, or after
    :meth:`open`, are removed by :meth:`close`. Results that still read them must be kept or written before."""

    active: list["Scratch"] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def open(self) -> "Scratch":
        Scratch.active.append(self)
        return self

    def leave(self) -> None:
        """Stop collecting, keep the tables until :meth:`close`."""
        if self in Scratch.active:
            Scratch.active.remove(self)

    def close(self) -> None:
        self.leave()
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)

    __enter__ = open

    def __exit__(self, *_) -> None:
        self.close()


def stored(df: DataFrame) -> str:
    """Write ``df`` as a table in the shared folder; returns its path. An open :class:`Scratch` owns it."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/lumenfit-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if Scratch.active:
        Scratch.active[-1].paths.append(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Passes that reuse it then scan columnar files with pruning, and a lost executor costs a
    re-read instead of a recomputation of everything before it. An open :class:`Scratch` owns it.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored(df))


# Rows one task should have before a table is worth spreading over more of them.
ROWS_PER_TASK = 50_000


def with_partition(df: DataFrame) -> DataFrame:
    """Add the number of the partition a row arrives in, for ``partition_count``."""
    return df.withColumn("_partition", F.spark_partition_id())


def partition_count() -> Column:
    """The number of partitions, as an aggregate for passes that run anyway."""
    return (F.max("_partition") + 1).alias("partitions")


def spread(df: DataFrame, rows: int, partitions: int) -> DataFrame:
    """Use all cores for a table that arrives in few partitions, such as one small file.

    Tables of a size that matters arrive in many partitions and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(cores, -(-rows // ROWS_PER_TASK))
    return df.repartition(wanted) if wanted > partitions else df
