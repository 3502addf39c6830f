"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or a temporary folder where a single machine runs all."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docketry-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialised(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once as parquet below the shared folder and read back.

    Its branches don't compute it again, lost executors cost no lineage, and the optimizer knows its
    true size.
    """
    path = f"{shared_dir(df.sparkSession)}/docketry-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, task_bytes: int = 16 << 20) -> int:
    """Partitions for a shuffle of ``df`` before costly work: by its size as the optimizer knows it, at least as many as the session asks for.

    The optimizer takes a join for the product of its sides, which is no size: beyond sixteen times the
    tables that are read, these count.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    known = min(size, 16 * read)
    known = known if known < 1 << 60 else 0  # beyond that the optimizer doesn't know
    return max(-(-known // task_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
