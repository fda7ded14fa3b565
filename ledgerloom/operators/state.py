"""Tables between steps of an iteration, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on a local master a folder of its own where that is unset (tests), else an error."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        found = context.getCheckpointDir()
    return found


def written(df: DataFrame) -> DataFrame:
    """df, computed once: written as Parquet below the shared folder and read again, so lost executors cost one step."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes tables of written() that no frame still to be run reads."""
    for f in frames:
        target = f.sparkSession._jvm.org.apache.hadoop.fs.Path(f._written)
        target.getFileSystem(f.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
