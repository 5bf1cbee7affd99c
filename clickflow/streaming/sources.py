"""Stream sources.

``open_stream`` gives a streaming DataFrame with a text ``value`` column,
plus ``seq`` (arrival order) when the source has one. Offsets are tracked by
the query's checkpoint (``checkpointLocation``), which replaces the
reference's hand-kept offset store: a restarted query resumes after the last
committed batch, and output + offsets commit together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_seq(partition: str, offset: str) -> F.Column:
    """One number ordering by (partition, offset): partitions are below 2^15,
    offsets below 2^44 here, so it also stays below 10^18."""
    return F.shiftleft(F.col(partition).cast("long"), 44) + F.col(offset)


def open_stream(spark: SparkSession, kind: str = "files", *, path: str | None = None,
                fmt: str = "text", schema=None, topic: str | None = None,
                servers: str | None = None, starting_offsets: str = "latest",
                max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None,
                group_id: str | None = None) -> DataFrame:
    """Subscribe to one topic (``kind='kafka'``) or watch a folder
    (``kind='files'``; ``fmt`` text or parquet).

    Topic records come out as ``value`` text with ``seq``, a number that
    orders by (partition, offset) and is unique over the topic, and their
    ``partition``. Records that expired before they were read fail the query
    (the connector's default) rather than being skipped. ``group_id`` names
    the consumer group for brokers that authorise by it; progress is always
    the checkpoint's. The Kafka connector must be on the cluster's classpath.
    """
    if kind == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if group_id:
            r = r.option("kafka.group.id", group_id)
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return r.load().select(F.col("value").cast("string").alias("value"),
                               topic_seq("partition", "offset").alias("seq"), "partition")
    if kind != "files":
        raise ValueError("kind must be 'files' or 'kafka'")
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)

