"""Tables written batch by batch, with bounded listings.

Layout below a store's path::

    gen=<g>/<partition>=<v>/batch_id=<n>/...   batches written under version g
    gen=<g>/batch_id=<n>/...                   the same without a partition column
    base=<g>/[<partition>=<v>/]...             all batches up to version g's last
    _commits/<g>/<n>                           marker: batch n is whole
    _version/<g>                               pointer: {"last": n}

A batch counts once its marker is there, so a reader never sees half of one and
a batch that runs again changes nothing. ``compact`` folds everything that
counts into the next base and then sets the next version's pointer, a single
rename: readers go by the highest version and see each row once, before, while
and after. They list the base and the batches of the version and the one
before it, not those of all time; what older versions hold is out of use and
can be expired.

One writer (a streaming query) per store; its batch numbers ascend. Compaction
may run beside it, one at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


class Store:
    """A table of ``schema`` at ``path``, in folders per ``partition``."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType,
                 partition: str | None = None):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.stored = T.StructType([*self.schema, T.StructField(BATCH, T.LongType())])
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- files ---------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        if not self._fs.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(p)]

    def _put(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        draft = self._path(f"_drafts/{name.replace('/', '-')}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(name)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(draft, target) and not self._fs.exists(target):
            raise OSError(f"cannot write {target}")

    def version(self) -> tuple[int, int]:
        """(version, last batch that its base holds); (0, none) at first."""
        found = [int(n) for n in self._names("_version") if n.isdigit()]
        if not found:
            return 0, -(1 << 62)
        f = self._fs.open(self._path(f"_version/{max(found)}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
        finally:
            f.close()
        return max(found), json.loads(text)["last"]

    def _commits(self, gen: int) -> set[int]:
        return {int(n) for n in self._names(f"_commits/{gen}") if n.lstrip("-").isdigit()}

    # ---- rows ----------------------------------------------------------------

    def append(self, df: DataFrame, batch_id: int) -> bool:
        """Store a batch's rows. False, and nothing done, if it is there
        already: batches are deterministic, so its rows are the same."""
        gen, last = self.version()
        if batch_id <= last or any(batch_id in self._commits(g) for g in (gen, gen - 1)):
            return False
        while True:
            w = (df.select(*self.schema.names).withColumn(BATCH, F.lit(batch_id).cast("long"))
                 .write.mode("overwrite"))
            if self.partition:
                # partition first, batch second; only this batch's folders are replaced
                (w.option("partitionOverwriteMode", "dynamic").partitionBy(self.partition, BATCH)
                 .parquet(f"{self.path}/gen={gen}"))
            else:
                w.option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(
                    f"{self.path}/gen={gen}")
            now, _ = self.version()
            if now - gen < 2:      # read as the version's or the one before it
                self._put(f"_commits/{gen}/{batch_id}", "")
                return True
            gen = now

    def read(self, before: int | None = None, values: list | None = None) -> DataFrame:
        """The rows of whole batches (numbered below ``before``) with their
        ``batch_id``; with ``values`` only of these values' folders."""
        return self._read(*self.version(), before, values)

    def folders(self) -> list[str]:
        """The folders that a read now would list."""
        gen, last = self.version()
        return [self._path(x).toString() for x, _ in self._pieces(gen, last)]

    def _pieces(self, gen: int, last: int) -> list[tuple[str, set[int] | None]]:
        out = [(f"base={gen}", None)] if gen else []
        for g in (gen - 1, gen):
            live = {n for n in self._commits(g) if n > last} if g >= 0 else set()
            if live:
                out.append((f"gen={g}", live))
        return out

    def _read(self, gen: int, last: int, before: int | None, values: list | None) -> DataFrame:
        out = self.spark.createDataFrame([], self.stored)
        for folder, live in self._pieces(gen, last):
            if not self._fs.exists(self._path(folder)):
                continue           # batches without rows leave no folder
            paths = [f"{self.path}/{folder}"]
            if self.partition and values is not None:
                names = [f"{folder}/{self.partition}={v}" for v in values]
                paths = [f"{self.path}/{n}" for n in names if self._fs.exists(self._path(n))]
                if not paths:
                    continue
            d = (self.spark.read.schema(self.stored).option("basePath", f"{self.path}/{folder}")
                 .parquet(*paths))
            if live is not None:
                d = d.where(F.col(BATCH).isin(sorted(live)))
            out = out.unionByName(d)
        if self.partition and values is not None:
            out = out.where(F.col(self.partition).isin(values))
        return out if before is None else out.where(F.col(BATCH) < before)

    def compact(self, merge: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Fold all whole batches into the next version's base; returns the
        version. Without new batches nothing is done. ``merge`` replaces the
        rows by fewer that mean the same (say, the last of each key); they
        then belong to the last batch folded."""
        gen, last = self.version()
        live = [n for _, some in self._pieces(gen, last) if some for n in some]
        if not live:
            return gen
        rows = self._read(gen, last, max(live) + 1, None)
        if merge:
            rows = merge(rows.drop(BATCH)).select(*self.schema.names).withColumn(
                BATCH, F.lit(max(live)).cast("long"))
        w = rows.write.mode("overwrite")
        if self.partition:
            w = w.partitionBy(self.partition)
        w.parquet(f"{self.path}/base={gen + 1}")
        self._put(f"_version/{gen + 1}", json.dumps({"last": max(live)}))
        return gen + 1
