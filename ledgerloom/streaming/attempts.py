"""Work lists over arriving readings with keyed state: the last attempt of each key, receipts, and a lease on the output.

The state is Structured Streaming's own: a running aggregate by key in update mode, so a batch gives the keys that changed.
Each batch is a folder that a retry overwrites; its receipt is written after it, and a folder without a receipt is work in
progress that no reader counts. Files are reached through the file system of the path, on a cluster as on a laptop.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LeaseHeld(RuntimeError):
    """Another run holds the output."""


class _Files:
    """The few file operations that leases and receipts need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def create(self, name: str, text: str) -> bool:
        """Whether the file is new and now holds the text; an existing one stays as it is."""
        try:
            out = self.fs.create(self.path(name), False)
        except Exception as e:
            if self.fs.exists(self.path(name)):
                return False
            raise e
        out.write(text.encode())
        out.close()
        return True

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []


class Lease:
    """One writer at a time: a file that is created only if it isn't there, with an owner and an end.

    A lease past its end is taken over. Leaving the block gives it back; a run that dies leaves it to its end.
    """

    def __init__(self, spark: SparkSession, root: str, seconds: float = 3600.0, now=time.time):
        self.files, self.seconds, self.now, self.owner = _Files(spark, root), seconds, now, uuid.uuid4().hex

    def __enter__(self) -> Lease:
        mine = json.dumps({"owner": self.owner, "until": self.now() + self.seconds})
        if not self.files.create("_lease", mine):
            held = self.files.read("_lease")
            if held and json.loads(held)["until"] > self.now():
                raise LeaseHeld(f"held until {json.loads(held)['until']:.0f}")
            self.files.delete("_lease")
            if not self.files.create("_lease", mine):
                raise LeaseHeld("another run took it over")
        return self

    def __exit__(self, *_) -> None:
        held = self.files.read("_lease")
        if held and json.loads(held)["owner"] == self.owner:
            self.files.delete("_lease")


def accepted(readings: DataFrame, requests: DataFrame, key: Sequence[str], identity: Sequence[str], digest: str, status: str = "status", good: str = "ok") -> DataFrame:
    """readings with `accepted`: of a good status, for a request of their key, equal to it in identity and content digest.

    Nulls are equal to nulls in identity, never in digest or status. Readings without a request aren't accepted.
    """
    asked = requests.select(*key, *[F.col(c).alias(f"_asked_{c}") for c in (*identity, digest)], F.lit(True).alias("_asked")).dropDuplicates([*key, *[f"_asked_{c}" for c in (*identity, digest)]])
    same = F.col("_asked") & (F.col(status) == good) & (F.col(digest) == F.col(f"_asked_{digest}"))
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"_asked_{c}"))
    return readings.join(asked, list(key), "left").select(*readings.columns, F.coalesce(same, F.lit(False)).alias("accepted"))


def run_attempts(spark: SparkSession, source: str, schema: T.StructType, key: Sequence[str], order: Sequence[str], checkpoint: str, out: str, files: int = 100, seconds: float = 3600.0) -> int:
    """Reads what has arrived since the last run and writes the keys that changed, with their last reading; the number of batches.

    order: columns that tell the last of a key's readings (the greatest; equal ones by the rest of the row). The state of
    keys is in the checkpoint, so a restart goes on where the last run ended, and a reading that comes late and isn't
    the last changes nothing. The lease keeps two runs apart.
    """
    rest = [f.name for f in schema if f.name not in key and f.name not in order]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    row = F.struct(*order, *rest, F.lit(1).alias("_one"))
    last = stream.groupBy(*key).agg(F.max(row).alias("_row"), F.count("*").alias("readings"))
    files_, done = _Files(spark, out), []

    def write(batch: DataFrame, number: int) -> None:
        flat = batch.select(*key, *[F.col(f"_row.{c}").alias(c) for c in (*order, *rest)], "readings")
        files_.delete(f"_receipts/{number}.json")
        flat.write.mode("overwrite").parquet(f"{out}/batch={number}")
        rows = spark.read.parquet(f"{out}/batch={number}").count()
        files_.create(f"_receipts/{number}.json", json.dumps({"batch": number, "rows": rows}))
        done.append(number)

    with Lease(spark, out, seconds):
        query = last.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return len(done)


def in_progress(spark: SparkSession, out: str) -> list[str]:
    """Batches that were begun and have no receipt: a run died in them, and the next one writes them again."""
    files = _Files(spark, out)
    return [b for b in files.names("") if b.startswith("batch=") and f"{b.removeprefix('batch=')}.json" not in files.names("_receipts")]


def current(spark: SparkSession, out: str, key: Sequence[str]) -> DataFrame:
    """One row a key, as of the last batch with a receipt: its last reading and how many there were."""
    files = _Files(spark, out)
    whole = [n.removesuffix(".json") for n in files.names("_receipts") if n.endswith(".json")]
    if not whole:
        raise ValueError(f"{out} has no finished batch")
    rows = spark.read.option("basePath", out).parquet(*[f"{out}/batch={n}" for n in whole])
    rest = [c for c in rows.columns if c not in key and c != "batch"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
