"""Driver tables and strict snapshot scans."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def workers_find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the driver found it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strict_flag(c: str):
    """"" to null, 0 and 1 to booleans; anything else is an error."""
    v = F.col(c)
    return F.when(v.isNull() | (v == ""), None).when(v == "1", True).when(v == "0", False).otherwise(F.raise_error(F.concat(F.lit(f"bad flag in {c}: "), v)).cast("boolean"))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV whose header is the contract's, all text, then typed: "" is null, flags are 0 or 1, identifiers stay text.

    A header that differs, ragged rows and bad flags are errors; rows and duplicates stay. An empty file is an error.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    head = spark.read.text(path).limit(1).collect()
    if not head:
        raise ValueError(f"{path} is empty")
    names = [n.strip('"') for n in head[0][0].lstrip("﻿").split(",")]
    if names != schema.names:
        raise ValueError(f"header {names} is not the contract's")
    df = spark.read.schema(raw).csv(path, header=True, enforceSchema=False, mode="FAILFAST", nullValue="")
    typed = [strict_flag(f.name).alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.when(F.col(f.name) == "", None).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema]
    return df.select(*typed)


def pinned(spark: SparkSession, paths: dict[str, str]) -> None:
    """Refuses files whose SHA-256 isn't the pinned one; digests are made where the files are read."""
    found = {r["path"]: r["sha"] for r in file_inventory(spark, list(paths)).select("path", "sha").collect()}
    bad = [p for p, sha in paths.items() if sha not in [s for f, s in found.items() if f.endswith(p.split("://")[-1].rstrip("/"))]]
    if bad:
        raise ValueError(f"not the pinned content: {bad}")


def file_inventory(spark: SparkSession, paths: list[str], pattern: str = "*") -> DataFrame:
    """`path, bytes, sha` of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(paths).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha"))


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document a file, with the file's path and digest."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.from_json(F.decode("content", "UTF-8"), schema, {"mode": "FAILFAST"}).alias("doc"), "path", F.sha2("content", 256).alias("sha"))


def last_record(df: DataFrame, key: str, position: str) -> DataFrame:
    """A ledger's last record for each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(position)).alias("_r")).select(key, "_r.*")


def word_lines(words: DataFrame, by: list[str], line: str, left: str, top: str, text: str) -> DataFrame:
    """Positioned words to lines in reading order: `by..., line, top, text`."""
    g = words.groupBy(*by, line).agg(F.min(top).alias("top"), F.sort_array(F.collect_list(F.struct(left, text))).alias("_w"))
    return g.select(*by, line, "top", F.array_join(F.transform("_w", lambda w: w[text]), " ").alias("text"))


def read_words(spark: SparkSession, path: str, schema: T.StructType, level: int | None = None) -> DataFrame:
    """Word rows of (gzipped) tab-separated files without quoting; of one `level`, if it is given (5: words)."""
    d = spark.read.schema(schema).csv(path, sep="\t", quote="", header=True)
    return d if level is None else d.filter(F.col("level") == level)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """CSV of all columns as texts, named by the header; missing cells are null."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    """`path, member, bytes, sha` of the files in (compressed) tar archives; an archive is read where it is opened."""
    import hashlib
    import io
    import tarfile

    import pandas as pd

    def scan(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    rows += [(name, m.name, m.size, hashlib.sha256(t.extractfile(m).read()).hexdigest()) for m in t.getmembers() if m.isfile()]
            yield pd.DataFrame(rows, columns=["path", "member", "bytes", "sha"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(scan, "path string, member string, bytes long, sha string")


def json_packets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """`path, sha, packet` of (gzipped) files that hold one JSON document each; sha is of the bytes as stored.

    A file that isn't such a document is an error. A packet is a row, so it has to fit into one.
    """
    stored = spark.read.format("binaryFile").load(path).select(F.col("path"), F.sha2("content", 256).alias("sha"))
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    parsed = read.select(F.col("_metadata.file_path").alias("_at"), F.struct(*schema.names).alias("packet"))
    plain = lambda c: F.regexp_replace(F.col(c), "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  file:/ and file:/// name one file
    return stored.join(parsed, plain("path") == plain("_at")).select("path", "sha", "packet")


def named_by_manifest(df: DataFrame, manifest: DataFrame, path: str, saved_as: str, take: list[str]) -> DataFrame:
    """df with the manifest's columns `take` for the file name that ends its path; null for files that aren't listed."""
    listed = manifest.select(F.col(saved_as).alias("_name"), *take)
    return df.withColumn("_name", F.regexp_extract(path, "([^/]*)$", 1)).join(listed, "_name", "left").select(*df.columns, *take)
