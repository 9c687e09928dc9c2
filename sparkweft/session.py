"""Small things that several operators need of a session."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: A side of a join is broadcast only if its rows were counted and stay below this bound.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: for costly work on few, small files. Larger inputs have more splits and stay."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n and df.rdd.getNumPartitions() < n else df


def dealt(df: DataFrame) -> DataFrame:
    """df evenly over its partitions, of which there are as many as cores at least: for work that grows faster than the rows, on files whose parts differ."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the cluster's shared folder. Where none is set, as in tests, one of our own if everything runs on this machine."""
    sc = df.sparkSession.sparkContext
    if not (df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()):
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="sparkweft-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir"))
    return df.checkpoint()
