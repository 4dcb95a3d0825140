"""Lineage cuts: tables written under the checkpoint folder the cluster shares.

A staged table survives the loss of any executor, is read back column-pruned, and gives
Spark true file sizes to plan the next join with.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which driver and executors must share.

    Where none is set a temporary one will do for a local master only; on a cluster that is an error.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="quillmill-")
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return root.rstrip("/")


def _staging_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/quillmill/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{_staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_staging(spark: SparkSession) -> None:
    """Delete what this application has staged, once nothing that reads it is needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_staging_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as parquet and go on from the written table."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`stage`, and the number of rows, counted while they were written."""
    written = Observation()
    staged = stage(df.observe(written, F.count(F.lit(1)).alias("rows")), name)
    return staged, written.get["rows"]


# Shuffle input per partition to start from; adaptive execution merges what turns out small.
BYTES_PER_PARTITION = 64 * 2**20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


_sized: dict[str, str] = {}


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles with enough partitions for an input of this size.

    Goes by each run anew; a number that the session sets itself is left alone.
    """
    application, now = spark.sparkContext.applicationId, spark.conf.get(INITIAL_PARTITIONS, None)
    if now is not None and now != _sized.get(application):
        return
    wanted = input_bytes // BYTES_PER_PARTITION
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        _sized[application] = str(wanted)
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    elif now is not None:
        spark.conf.unset(INITIAL_PARTITIONS)
