"""Resumable work over arriving files: available-now streams whose checkpoint is the receipt of what is done."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_available(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, out: str, work: Callable[[DataFrame], DataFrame], files: int = 100) -> int:
    """Processes files that haven't been, then ends; the number of micro-batches. Output of a batch is a folder that a retry overwrites."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    done = []

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        done.append(number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)


def latest_attempt(df: DataFrame, key: Sequence[str], attempt: str) -> DataFrame:
    """The last attempt of each key among re-read results."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(attempt)).alias("_r")).select(*key, "_r.*")


def event_windows(events: DataFrame, ts: str, width: str, *keys: str, late: str | None = None) -> DataFrame:
    """Counts in tumbling windows; with a watermark on a stream, windows close that much after the latest event."""
    d = events.withWatermark(ts, late) if late else events
    return d.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")
