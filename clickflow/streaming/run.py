"""Starting streaming queries (ST6, S5) with checkpointed progress.

Every query gets a checkpoint folder under the cluster's shared checkpoint
dir (``spark.checkpoint.dir``), so offsets, state and sink commits survive a
restart or a lost executor, and a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickflow.session import sub_dir

DEFAULT_INTERVAL = "5 seconds"   # the reference's micro-batch interval


def start(df: DataFrame, name: str, *, sink: str = "parquet", path: str | None = None,
          mode: str = "append", trigger: str | None = DEFAULT_INTERVAL,
          checkpoint: str | None = None, partition_by: list[str] | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          options: dict[str, str] | None = None) -> StreamingQuery:
    """Start ``df`` as query ``name``.

    ``sink``: 'parquet' / 'json' / 'text' (file sinks, exactly-once via
    their commit log), 'memory' (tests), 'console' (K4), 'kafka' (K1; needs
    the connector) or 'foreach_batch' with ``foreach_batch(df, batch_id)``.
    ``trigger``: a processing-time interval, or 'availableNow' to drain what
    is there and stop (tests, backfills).
    """
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or sub_dir(spark, "streams", name)))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if sink == "foreach_batch":
        return w.foreachBatch(foreach_batch).start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    if sink in ("parquet", "json", "text"):
        return w.format(sink).start(path)
    return w.format(sink).start()


def late_rows(q: StreamingQuery) -> int:
    """Rows the query's stateful operators dropped as later than the
    watermark, over the progress it still holds. Alert on it; the rows can be
    replayed from the raw archive (K5)."""
    return sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)


def drain(q: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its error."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
