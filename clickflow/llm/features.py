"""Dense document features by numpy over flat text, for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.flat import Flat, as_bytes, byte_table, chunks, release_memory
from clickflow.llm.sqltext import crc_fold, ready_workers

Extract = Callable[[list[bytes]], np.ndarray]

_UPPER = byte_table(bytes(range(65, 91)))
_LOWER = byte_table(bytes(range(97, 123)))
_DIGIT = byte_table(b"0123456789")
_HIGH = byte_table(bytes(range(128, 256)))
_SYMBOL = byte_table(b"#*$%&|<>{}[]\\^~=+_@/")
_POINT = byte_table(b".,;:!?")
_SHOUT = byte_table(b"!?")
_END = byte_table(b".!?\"')")

QUALITY = ["log_words", "mean_word", "word_spread", "upper", "digit", "symbol", "point", "shout",
           "beyond_ascii", "caps_words", "symbol_words", "short_words", "type_rate",
           "repeat_3", "same_next", "top_word", "dup_lines", "lines_per_word", "ended_lines"]


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _per_doc_runs(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, count of the most frequent key) of each document."""
    o = np.lexsort((key, doc))
    d, k = doc[o], key[o]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(d)))
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, d[at], size)
    return np.bincount(d[at], minlength=n), top


def quality_features(texts: list[bytes]) -> np.ndarray:
    """One row per text, columns ``QUALITY``; a text without words is 0."""
    f = Flat(texts)
    n, words = f.n, f.doc_words.astype(float)
    length = (f.end - f.start).astype(float)
    chars = f.per_word_sum(length)
    mean = ratio(chars, words)
    spread = np.sqrt(np.maximum(ratio(f.per_word_sum(length ** 2), words) - mean ** 2, 0))

    def in_words(table: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(table[f.raw], dtype=np.int64)))
        return c[f.end] - c[f.start]

    up, low, sym = in_words(_UPPER), in_words(_LOWER), in_words(_SYMBOL)
    hashes = f.word_hash()
    types, top = _per_doc_runs(f.doc, hashes, n)
    d3, h3 = f.shingles(3)
    kinds3, _ = _per_doc_runs(d3, h3, n)
    runs3 = np.bincount(d3, minlength=n)
    same = np.zeros(n)
    if len(hashes) > 1:
        eq = (hashes[1:] == hashes[:-1]) & (f.doc[1:] == f.doc[:-1])
        same = np.bincount(f.doc[1:][eq], minlength=n)
    # lines: a word opens one if a line feed (or the text's start) is before it
    feeds = np.concatenate(([0], np.cumsum(f.raw == 10, dtype=np.int64)))
    opens = np.ones(len(f.start), dtype=bool)
    opens[1:] = (f.doc[1:] != f.doc[:-1]) | (feeds[f.start[1:]] != feeds[f.end[:-1]])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(f.start)) - 1
    lines, line_doc, dup = np.zeros(n), f.doc[first], np.zeros(n)
    ended = np.zeros(n)
    if len(first):
        lines = np.bincount(line_doc, minlength=n).astype(float)
        line_hash = f.hash_range(f.start[first], f.end[last])
        line_kinds, _ = _per_doc_runs(line_doc, line_hash, n)
        dup = lines - line_kinds
        ended = np.bincount(line_doc, weights=_END[f.raw[f.end[last] - 1]], minlength=n)
    cols = [
        np.log1p(words), mean, spread,
        ratio(f.per_word_sum(up), chars), ratio(f.per_word_sum(in_words(_DIGIT)), chars),
        ratio(f.per_word_sum(sym), chars), ratio(f.per_word_sum(in_words(_POINT)), chars),
        ratio(f.per_word_sum(in_words(_SHOUT)), chars),
        ratio(f.per_word_sum(in_words(_HIGH)), chars),
        ratio(f.per_word_sum((up >= 2) & (low == 0)), words), ratio(f.per_word_sum(sym > 0), words),
        ratio(f.per_word_sum(length <= 2), words), ratio(types, words),
        ratio(runs3 - kinds3, runs3), ratio(same, words), ratio(top, words), ratio(dup, lines),
        ratio(lines, words), ratio(ended, lines)]
    return np.column_stack(cols).astype(float)


def feature_rows(docs: DataFrame, extract: Extract, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``x`` (array of doubles) from its
    ``text``. Runs on Arrow batches, a bounded chunk of bytes at a time; a
    NULL text is empty."""
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + ", x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(b.schema.get_field_index("text")))
            for lo, hi in chunks(texts):
                x = extract(texts[lo:hi])
                width = x.shape[1]
                offsets = pa.array(np.arange(0, (hi - lo + 1) * width, width), pa.int32())
                rows = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).slice(lo, hi - lo) for c in keep], rows], [*keep, "x"])
            release_memory()

    ready_workers(docs.sparkSession)
    return docs.select(*keep, "text").mapInArrow(run, schema)


def keep_rows(docs: DataFrame, wanted: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text ``wanted`` (a mask for texts) holds for;
    all columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(at))
            for lo, hi in chunks(texts):
                yield b.slice(lo, hi - lo).filter(pa.array(wanted(texts[lo:hi])))
            release_memory()

    ready_workers(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def sample_ids(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id and y of at most ``max_rows`` labelled documents outside the
    held-out fold, in the order of a hash of the id. Several labels of an id
    are averaged and rounded up at one half."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                         & (crc_fold(F.col("doc_id")) != 0))
            .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


def collect_sample(rows: DataFrame, max_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(x, y) of the bounded sample, in a fixed order."""
    got = (rows.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(max_rows)
           .select("x", "y").toPandas())
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), width)
    return x, got["y"].to_numpy(dtype=float)

