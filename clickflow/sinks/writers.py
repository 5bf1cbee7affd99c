"""Batch writers, also used from ``foreachBatch`` for streams.

Tables written batch by batch are append-only. Outputs (``write_batch``): micro-
batch ``n`` owns the folder ``batch_id=n``, which appears whole by one rename and
is not written again by a replay, so a stream that reads such a folder takes each
row once. Tables that later batches read (documents, user state, re-ranked
windows) are a ``store.Store``: what earlier batches stored is read with
``batch_id < n``, and compaction beside the running stream keeps the number of
folders to list bounded. A failed read raises; only a path that does not exist
counts as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.operators.windows import top_k
from clickflow.sinks.store import BATCH, Store


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system; other errors surface."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def stored_before(spark: SparkSession, path: str, schema: T.StructType,
                  batch_id: int | None = None) -> DataFrame:
    """The rows of an append-only table that batches before ``batch_id`` (all
    for None) stored, with their ``batch_id``; no rows if there is no table."""
    full = T.StructType([f for f in schema.fields if f.name != BATCH]
                        + [T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    d = spark.read.schema(full).parquet(path)
    return d if batch_id is None else d.where(F.col(BATCH) < batch_id)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Write a batch's folder, unless it is there: it appears by one rename
    (atomic where the file system's renames are), so a replay and a reader
    beside it find it whole or not at all."""
    spark = df.sparkSession
    target = f"{path}/{BATCH}={batch_id}"
    if path_exists(spark, target):
        return
    draft = f"{path}/_drafts/{BATCH}={batch_id}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(draft)
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = hpath(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(hpath(draft), hpath(target)):
        raise OSError(f"cannot write {target}")


def open_store(spark: SparkSession, path: str, schema: T.StructType,
               partition: str | None = None) -> Store:
    """The store at ``path``; a failing file system surfaces here."""
    path_exists(spark, path)
    return Store(spark, path, schema, partition)


def compact(spark: SparkSession, path: str, out: str, schema: T.StructType,
            partition_by: list[str] | None = None) -> None:
    """Off line: a store's rows as one batch (``batch_id=-1``) of the table
    ``out``. ``Store.compact`` does the same in place."""
    d = open_store(spark, path, schema, partition_by[0] if partition_by else None).read().drop(BATCH)
    w = d.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{out}/{BATCH}=-1")


def write_topic(df: DataFrame, *, kind: str = "files", path: str | None = None,
                servers: str | None = None) -> None:
    """K1: write (topic, value[, key]) rows to their topics.

    ``kind='kafka'`` uses the Kafka sink (connector on the classpath, with
    idempotent producers if the cluster enables them) and sends the message
    key where the rows have one; ``kind='files'`` writes one folder per topic,
    the stand-in used where no broker exists (text lines, or JSON lines of key
    and value where the rows have a key).
    """
    keyed = "key" in df.columns
    if kind == "kafka":
        (df.select("topic", *(["key"] if keyed else []), "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).save())
    elif keyed:
        df.select("topic", "key", "value").write.mode("append").partitionBy("topic").json(path)
    else:
        df.select("topic", "value").write.mode("append").partitionBy("topic").text(path)


def replay_file_to_topic(spark: SparkSession, src: str, topic: str, **kw) -> None:
    """K2: every line of a text file becomes one message of ``topic``."""
    write_topic(spark.read.text(src).select(F.lit(topic).alias("topic"), "value"), **kw)


def archive_logs(df: DataFrame, path: str) -> None:
    """K5: raw lines, verbatim, one folder per event day (``dt``)."""
    df.select("dt", "value").write.mode("append").partitionBy("dt").text(path)


def upsert_docs(batch: DataFrame, path: str, batch_id: int, key: str = "id",
                partition: str = "dt") -> None:
    """K3: idempotent bulk write of documents, in folders per ``partition``.

    The batch's documents whose key no earlier batch stored are appended under
    ``batch_id``, so the first arrival wins and a replay changes nothing. Only
    the partitions that the batch touches are listed and read for their keys.
    ``docs_store`` reads and compacts the documents.
    """
    spark = batch.sparkSession
    batch = batch.dropDuplicates([key]).persist()
    try:
        store = docs_store(spark, path, batch.schema, partition)
        # the days of a micro-batch: a handful of values
        days = [r[0] for r in batch.select(partition).distinct().collect()]
        old = store.read(before=batch_id, values=days)
        store.append(batch.join(old.select(key), key, "left_anti"), batch_id)
    finally:
        batch.unpersist()


def docs_store(spark: SparkSession, path: str, schema: T.StructType, partition: str = "dt") -> Store:
    """The document store that ``upsert_docs`` writes."""
    return open_store(spark, path, schema, partition)


def ranked_batches(path: str, partition_by: list[str], order_by: list, k: int,
                   columns: list[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for top-k per window (T1/T2 streaming).

    In append mode a window's counts are released together, in one batch,
    once the watermark passes its end, so ranking inside the batch is exact.
    Each batch overwrites its own ``batch_id`` folder: a replayed batch
    rewrites the same rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(top_k(batch, partition_by, order_by, k).select(*columns), path, batch_id)
    return write


STATE_BUCKETS = 64
USER_STATE = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("if_consumed", T.StringType()),
                           T.StructField("bucket", T.IntegerType())])


def state_bucket(buckets: int = STATE_BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket")


def user_state_store(spark: SparkSession, path: str) -> Store:
    return open_store(spark, path, USER_STATE, "bucket")


def read_user_state(spark: SparkSession, path: str, batch_id: int | None = None,
                    buckets: list[int] | None = None) -> DataFrame:
    """J5's state: user_id, if_consumed as left by the batches before
    ``batch_id``; with ``buckets`` only those folders are listed and read. A user
    is consumed ('1') once any batch says so."""
    d = user_state_store(spark, path).read(batch_id, buckets)
    return d.groupBy("user_id").agg(F.max("if_consumed").alias("if_consumed"))


def init_user_state(state: DataFrame, path: str, buckets: int = STATE_BUCKETS) -> None:
    """Store a state known before the first batch (as batch -1)."""
    user_state_store(state.sparkSession, path).append(
        state.select("user_id", "if_consumed", state_bucket(buckets)), -1)


def touched_buckets(batch: DataFrame, buckets: int = STATE_BUCKETS) -> list[int]:
    """The bucket numbers of a batch's users: at most ``buckets`` values."""
    return [r[0] for r in batch.where("user_id is not null").select(state_bucket(buckets))
            .distinct().collect()]


def update_user_state(orders_batch: DataFrame, path: str, batch_id: int,
                      buckets: int = STATE_BUCKETS) -> None:
    """J5 as a sink: every buyer of the batch is consumed ('1') from the next
    batch on.

    The buyers that are not consumed yet are appended under ``batch_id``; only
    their buckets are read and nothing is rewritten. Choose ``buckets`` by the
    number of users (about a million users each) and keep it for a table's
    life. Running a batch again stores the same rows.
    """
    spark = orders_batch.sparkSession
    buyers = (orders_batch.where("user_id is not null").select("user_id").distinct()
              .select("user_id", state_bucket(buckets)).persist())
    try:
        known = read_user_state(spark, path, batch_id, touched_buckets(buyers, buckets))
        new = buyers.join(known.where(F.lower("if_consumed") == "1"), "user_id", "left_anti")
        user_state_store(spark, path).append(
            new.select("user_id", F.lit("1").alias("if_consumed"), "bucket"), batch_id)
    finally:
        buyers.unpersist()


def rerank_windows(counts_path: str, ranks_path: str, key: str, k: int,
                   count_col: str = "count") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for rankings that re-fire (T2 with late data).

    In update mode a batch holds only the (key, window) counts that changed.
    They are appended under ``batch_id``; the windows they touch are ranked
    again from each key's latest count and appended to ``ranks_path``, whose
    latest batch per window counts (``latest_ranks``). Each (key, window) has
    one -- the latest -- count, unlike the reference, which ranked a late url
    twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(key, "window_end", count_col).persist()
        try:
            span = batch.agg(F.min("window_end").alias("lo"), F.max("window_end").alias("hi")).first()
            counts = open_store(spark, counts_path, batch.schema)
            counts.append(batch, batch_id)
            # windows one micro-batch touches: bounded by its time span / slide
            touched = batch.select("window_end").distinct()
            old = counts.read(before=batch_id).where(
                F.col("window_end").between(span["lo"], span["hi"]))
            old = old.join(touched, "window_end", "left_semi")
            both = old.unionByName(batch.withColumn(BATCH, F.lit(batch_id).cast("long")))
            latest = both.groupBy(key, "window_end").agg(
                F.max_by(count_col, BATCH).alias(count_col))
            ranks = top_k(latest, ["window_end"], [F.desc(count_col), F.asc(key)], k)
            open_store(spark, ranks_path, ranks.schema).append(ranks, batch_id)
        finally:
            batch.unpersist()
    return write


def latest_ranks(spark: SparkSession, ranks_path: str, schema: T.StructType) -> DataFrame:
    """The current ranking of every window written by ``rerank_windows``."""
    d = open_store(spark, ranks_path, schema).read()
    last = d.groupBy("window_end").agg(F.max(BATCH).alias(BATCH))
    return d.join(last, ["window_end", BATCH]).drop(BATCH)
