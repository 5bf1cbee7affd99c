"""Column helpers and shared-folder tables used by the operators here."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import shared_dir, workers_find_package

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ARROW_ROWS = 1_000   # documents in an Arrow batch, at most


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    An expression used inside a lambda is otherwise evaluated again for every
    element the lambda visits; binding it as a lambda variable of a
    one-element ``transform`` avoids that.
    """
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, pattern: str = WORD) -> Column:
    """The runs of word characters, in order; NULL text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def split_words(text: Column, separators: str) -> Column:
    """The pieces of ``text`` between runs of separator characters (a regular
    expression of one or more of them); NULL text has none. Faster than
    extracting the words where the separators are a plain class."""
    def trimmed(x: Column) -> Column:
        first = F.when(x[0] == "", 1).otherwise(0)
        last = F.when(F.element_at(x, -1) == "", 1).otherwise(0)
        return F.slice(x, first + 1, F.greatest(F.size(x) - first - last, F.lit(0)))
    return let(F.split(F.coalesce(text, F.lit("")), separators), trimmed)


def chars_of(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (NULL id: NULL)."""
    return F.crc32(doc_id.cast("string")) % folds


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold; a NULL id is in no fold."""
    return F.coalesce(crc_fold(doc_id) == 0, F.lit(False))


def ready_workers(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Let Python workers import this package, and lower the session's rows per
    Arrow batch to ``rows`` if it is higher. Rows here are whole documents: the default of 10,000 would hold tens of
    megabytes of text, several times over, in every Python worker."""
    workers_find_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def save_shared(df: DataFrame, name: str, few_files: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared folder and read it
    back: lineage ends there, and a lost executor loses nothing. ``few_files``
    first evens out the rows over as many tasks as their size asks for, for
    results far smaller than what they were made from."""
    spark = df.sparkSession
    df = df.hint("rebalance") if few_files else df
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
