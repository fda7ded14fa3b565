"""Verified sinks: typed Parquet that is read again and compared, manifests, CSV and JSON lines."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.sets import differing
from ledgerloom.sources.tables import file_inventory


def write_parquet(df: DataFrame, path: str) -> None:
    """zstd Parquet; Spark's committer makes the files of a job visible together."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_checked(df: DataFrame, path: str) -> int:
    """Writes, reads again and compares as bags of rows; the number of rows. A difference is an error."""
    write_parquet(df, path)
    again = df.sparkSession.read.parquet(path)
    bad = differing(df, again).limit(3).collect()
    if bad:
        raise ValueError(f"{path} doesn't read back as written: {bad}")
    return again.count()


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The contract's columns in its order, nulls empty, one file."""
    df.select(*columns).repartition(1).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="", lineSep="\n")


def write_json_lines(df: DataFrame, path: str) -> str:
    """Gzipped JSON lines; returns a digest of the rows (sorted), which doesn't depend on how they are split."""
    df.write.mode("overwrite").json(path, compression="gzip")
    rows = df.select(F.sha2(F.to_json(F.struct("*")), 256).alias("h"))
    return content_digest(rows)


def content_digest(hashes: DataFrame) -> str:
    """An order-free digest: count, sum and xor of 64-bit halves of row hashes."""
    h = F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")
    r = hashes.agg(F.count("*").alias("n"), F.sum(h).alias("s"), F.bit_xor(h.cast("long")).alias("x")).head()
    return f"{r['n']}-{r['s']}-{r['x']}"


def manifest(spark: SparkSession, files: dict[str, str]) -> str:
    """JSON of tables (name -> path): schema, rows, and the digest of every file of a table; keys sorted.

    Digests are made where files are read; the driver gets a line a file.
    """
    out = {}
    for n, p in files.items():
        d, found = spark.read.parquet(p), file_inventory(spark, [p], "*.parquet").select("path", "bytes", "sha").collect()
        out[n] = {"rows": d.count(), "schema": {f.name: f.dataType.simpleString() for f in d.schema}, "files": {r["path"].rsplit("/", 1)[-1]: {"bytes": r["bytes"], "sha256": r["sha"]} for r in found}}
    return json.dumps(out, indent=2, sort_keys=True)


def checksums(inventory: DataFrame) -> DataFrame:
    """`line` of a SHA256SUMS file for each row of an inventory (`path, sha`): digest, two spaces, the file's name."""
    return inventory.select(F.concat(F.col("sha"), F.lit("  "), F.element_at(F.split("path", "/"), -1)).alias("line"))


def dictionary(df: DataFrame) -> list[dict]:
    """Columns with type and comment."""
    return [{"column": f.name, "type": f.dataType.simpleString(), "comment": f.metadata.get("comment", "")} for f in df.schema]


def replace_block(path: str, begin: str, end: str, text: str) -> None:
    """Replaces the text between two markers, of which there must be exactly one pair."""
    body = Path(path).read_text()
    if body.count(begin) != 1 or body.count(end) != 1 or body.index(begin) > body.index(end):
        raise ValueError("exactly one marked block is needed")
    head, rest = body.split(begin)
    Path(path).write_text(f"{head}{begin}\n{text}\n{end}{rest.split(end)[1]}")


def write_receipt(summary: DataFrame, path: str) -> str:
    """One row as a JSON file with sorted keys and a line feed, in place of an older one; the text. More rows are an error."""
    import json

    rows = summary.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a receipt is one row")
    text = json.dumps(rows[0].asDict(recursive=True), sort_keys=True, indent=2, default=str, ensure_ascii=False) + "\n"
    spark = summary.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(text.encode())
    out.close()
    return text
