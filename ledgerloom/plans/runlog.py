"""JSON-line events of commands: started, completed or failed, with duration and metrics of observed frames."""

from __future__ import annotations

import functools
import json
import os
import sys
import time
from datetime import UTC, datetime


def log(event: str, **fields) -> None:
    """One line on standard error; LEDGERLOOM_LOG=off silences it."""
    if os.environ.get("LEDGERLOOM_LOG", "on") != "off":
        print(json.dumps({"at": datetime.now(UTC).isoformat(timespec="milliseconds"), "event": event, **fields}, sort_keys=True, default=str), file=sys.stderr)


def command(f):
    """Logs the life of a command; its errors go on."""

    @functools.wraps(f)
    def run(*args, **kwargs):
        began = time.monotonic()
        log("command_started", command=f.__name__)
        try:
            out = f(*args, **kwargs)
        except BaseException as e:
            log("command_failed", command=f.__name__, seconds=round(time.monotonic() - began, 3), error=f"{type(e).__name__}: {e}")
            raise
        log("command_completed", command=f.__name__, seconds=round(time.monotonic() - began, 3))
        return out

    return run


def observed_write(df, path: str, name: str, mode: str = "errorifexists", **measures) -> dict:
    """Writes df as Parquet and logs `frame_written` with rows, further measures (aggregate columns) and bytes.

    Rows and measures are observed while the frame is written, so nothing runs twice; bytes are what the folder then holds.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    began, seen = time.monotonic(), Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in measures.items()]).write.mode(mode).parquet(path)
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
    out = {**seen.get, "bytes": size}
    log("frame_written", frame=name, path=path, seconds=round(time.monotonic() - began, 3), **out)
    return out


def stream_listener():
    """For `spark.streams.addListener`: a line for each batch of a stream, with what it observes, and for its start and end."""
    from pyspark.sql.streaming import StreamingQueryListener

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            log("stream_started", stream=event.name, run=str(event.runId))

        def onQueryProgress(self, event):
            p = event.progress
            log("stream_batch", stream=p.name, batch=p.batchId, rows=p.numInputRows, observed={k: v.asDict() for k, v in p.observedMetrics.items()})

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            log("stream_ended", run=str(event.runId), error=event.exception)

    return Listener()
