"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pagewright")
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for k, v in (conf | extra).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_base(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where the session names none, a session on one machine gets a folder of its own; on a cluster that would
    lose data, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage by a checkpoint in the shared folder."""
    _shared_base(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """Cut lineage by a Parquet table in the shared folder, for what is read several times by few of its columns."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in a partition per core at least, for work that is heavy on each row.

    A file of one row group is one partition, however many cores wait, so a table of fewer files than cores
    is shuffled once. Tables of more files have partitions enough and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{_shared_base(spark).rstrip('/')}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context, unless PYTHONPATH does so."""
    root = Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc in _shipped:
        return
    base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.addPyFile(shutil.make_archive(f"{base}/pagewright", "zip", root, "pagewright"))
    _shipped.append(sc)


_shipped: list = []
