"""A readable record of what each micro-batch took.

A query's checkpoint decides where it resumes; the ledger tells people and
other jobs: per committed batch the offsets of each topic partition (or the
source's own offset text) and how many rows came too late. It is a store, so it
is compacted like one and a batch is recorded once, however often it runs.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickflow.sinks.store import Store

LEDGER = ("query string, source string, topic string, partition int, start_offset string, "
          "end_offset string, input_rows long, late_rows long")


def _offsets(text: str | None) -> dict[tuple[str | None, int | None], str]:
    """{(topic, partition): offset} of a source's offset; one entry without
    topic for sources that have none."""
    if text is None or text == "null":
        return {}
    try:
        parsed = json.loads(text)
        if all(isinstance(p, dict) and all(k.isdigit() for k in p) for p in parsed.values()):
            return {(t, int(k)): str(v) for t, p in parsed.items() for k, v in p.items()}
    except (ValueError, AttributeError):
        pass
    return {(None, None): text}


def _rows(query: str, source: str, start: str | None, end: str | None, n: int | None,
          late: int | None) -> list[tuple]:
    a, b = _offsets(start), _offsets(end)
    # counts stand in a source's first row, so that they can be summed
    return [(query, source, t, p, a.get((t, p)), o, n if i == 0 else 0, late if i == 0 else 0)
            for i, ((t, p), o) in enumerate(sorted(b.items(), key=str))]


def ledger_store(spark: SparkSession, path: str, query: str) -> Store:
    return Store(spark, f"{path}/{query}", LEDGER)


class Ledger(StreamingQueryListener):
    """Records the batches of named queries below ``path``; add it with
    ``spark.streams.addListener``. A batch's progress is reported after its
    commit; ``fill`` adds what a crash in between left out."""

    def __init__(self, spark: SparkSession, path: str, queries: list[str] | None = None):
        self.spark, self.path, self.queries = spark, path, queries

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name is None or (self.queries is not None and p.name not in self.queries):
            return
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        rows = [r for i, s in enumerate(p.sources) for r in _rows(
            p.name, s.description, s.startOffset, s.endOffset, s.numInputRows, late if i == 0 else 0)]
        ledger_store(self.spark, self.path, p.name).append(
            self.spark.createDataFrame(rows, LEDGER).coalesce(1), p.batchId)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_ledger(spark: SparkSession, path: str, query: str) -> DataFrame:
    """The ledger's rows of a query with their batch_id."""
    return ledger_store(spark, path, query).read()


def fill(spark: SparkSession, path: str, query: str, checkpoint: str) -> int:
    """Record committed batches that the ledger lacks from the checkpoint's
    offset log (their row counts are NULL); returns how many. Run it before the
    query starts again. The checkpoint keeps its last 100 batches."""
    store = ledger_store(spark, path, query)
    known = {r[0] for r in store.read().select("batch_id").distinct().collect()}
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = hpath(checkpoint).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(folder: str) -> set[int]:
        p = hpath(f"{checkpoint}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return {int(n) for n in names if n.isdigit()}

    def sources(batch: int) -> list[str]:
        # a version line, the batch's metadata, then one line a source
        lines = [r[0] for r in spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).collect()]
        return lines[0].split("\n")[2:] if lines else []

    logged, n = numbers("offsets"), 0
    for batch in sorted(numbers("commits") & logged - known):
        before = sources(batch - 1) if batch - 1 in logged else []
        rows = [r for i, end in enumerate(sources(batch)) for r in _rows(
            query, f"source {i}", before[i] if i < len(before) else None, end, None, None)]
        n += store.append(spark.createDataFrame(rows, LEDGER).coalesce(1), batch)
    return n


def late_total(spark: SparkSession, path: str, query: str) -> int:
    """Rows that a query's batches dropped as late, all of them."""
    return read_ledger(spark, path, query).agg(F.sum("late_rows")).first()[0] or 0


def starting_offsets(spark: SparkSession, path: str, query: str) -> str:
    """Where the recorded batches of a query end, as the starting offsets of a
    topic source (``open_stream(starting_offsets=...)``), for a new query that
    goes on where it stopped."""
    last = (read_ledger(spark, path, query).where("topic is not null").groupBy("topic", "partition")
            .agg(F.max_by(F.col("end_offset"), F.col("batch_id")).alias("o")).collect())
    out: dict[str, dict[str, int]] = {}
    for r in sorted(last):
        out.setdefault(r.topic, {})[str(r.partition)] = int(r.o)
    return json.dumps(out)
