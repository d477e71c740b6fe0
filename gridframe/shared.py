"""The folder that driver and executors share, for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing on one machine (tests, a laptop) a temporary folder becomes
    the checkpoint folder. A cluster has to name one that all machines reach, else this raises.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(known)
        return known.rstrip("/")
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="gridframe-shared-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/gridframe-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
