"""Shared pieces of the training-data operators: scratch tables, word and line rules, worker set-up."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and line rules, as characters and as the inside of a regex class.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_written: list[tuple[SparkSession, str]] = []
#: What this process remembers between tasks, so that another operator's task can take the memory.
worker_caches: list[dict] = []


def release() -> None:
    """Returns memory that Arrow and the C library keep for later."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: the memory is reused all the same


def free_caches() -> None:
    """Empties the caches that reused workers hold for other operators and returns the memory."""
    if any(worker_caches):
        for cache in worker_caches:
            cache.clear()
        gc.collect()
        release()


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package wherever the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder set here where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    found = spark.sparkContext.getCheckpointDir()
    if found is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if found is None:
        local = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(local)
        found = spark.sparkContext.getCheckpointDir()
    return found


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder. Results read from it lazily, so it stays until cleanup()."""
    path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cleanup(spark: SparkSession) -> int:
    """Deletes every scratch path of this session; call it when no result of these operators is read any more."""
    gone = 0
    for held, path in list(_written):
        if held is spark:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            gone += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
            _written.remove((held, path))
    return gone


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings for the jobs run within; dots are written as two underscores."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    was = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet below the shared folder and reads it again: cuts lineage, survives lost executors.

    The shuffle files of the job go when it ends; a written table never needs them again.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes tables that stash() wrote; only for those that no frame still to be run reads."""
    for f in frames:
        target = f.sparkSession._jvm.org.apache.hadoop.fs.Path(f._scratch)
        target.getFileSystem(f.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def text_of(name: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lines_of(text: Column) -> Column:
    """All lines of a text, split at \\n only; the empty text has one empty line."""
    return F.split(text, "\n", -1)


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.filter(F.split(text, f"[{WS_CLASS}]+", -1), lambda w: w != "")


def ascii_lower(s: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII alone take the faster built-in."""
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(F.translate(s, UPPER, UPPER.lower()))

