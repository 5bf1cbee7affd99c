"""Indexed document search (F6, T3): postings, relevance, and one page's texts.

An index is three stores: ``postings`` (a row per token and block of documents,
in folders by token hash), ``texts`` (the documents, in folders by block) and
``sizes`` (documents and tokens per batch). A query reads the folders of its
tokens, intersects their postings, orders what is left by relevance or by the
stored fields, and then reads the texts of that page's documents alone.

Documents are added batch by batch; blocks hold about ``BLOCK_DOCS`` of them, so a
frequent token has many postings of bounded size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.text import highlight, tokens
from clickflow.session import workers_find_package
from clickflow.sinks.store import Store

BLOCK_DOCS = 4096
SHARDS = 32
# The usual constants of the BM25 score.
K1, B = 1.2, 0.75


def _shard(token: Column | str, shards: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(shards)).cast("int")


def _words(text: Column | str) -> Column:
    return tokens(F.coalesce(text, F.lit("")))


def _block_postings(docs: pa.Table) -> pa.Table:
    """token, block and entries of one block's documents, whose ``words`` are a
    list per text: occurrences are put in order of (token, document, position),
    and the runs of equal pairs are the entries."""
    docs = docs.sort_by("doc_id").combine_chunks()
    by_doc = docs["words"].combine_chunks()
    by_text = by_doc.flatten()
    words = by_text.flatten().dictionary_encode()
    texts, lengths, n = by_doc.value_lengths().to_numpy(), by_text.value_lengths().to_numpy(), len(docs)
    at = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    pair = words.indices.to_numpy().astype("int64") * n + np.repeat(np.repeat(np.arange(n), texts), lengths)
    # stable: positions ascend already where a document has one text
    order = np.lexsort((at, pair) if texts.max() > 1 else (pair,))
    at, pair = at[order], pair[order]
    entry = np.flatnonzero(np.diff(pair, prepend=-1))
    word, doc = np.divmod(pair[entry], n)
    first = np.flatnonzero(np.diff(word, prepend=-1))

    def lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)

    kept = docs.drop_columns(["block", "words"]).take(pa.array(doc)).combine_chunks()
    columns = {c: kept[c].combine_chunks() for c in kept.column_names}
    columns = {"doc_id": columns.pop("doc_id"), "positions": lists(entry, pa.array(at, pa.int32())), **columns}
    return pa.table({
        "token": words.dictionary.take(pa.array(word[first])), "block": docs["block"].take(pa.array(first * 0)),
        "entries": lists(first, pa.StructArray.from_arrays([*columns.values()], [*columns]))})


class SearchIndex:
    """An index at ``path`` of documents with ``schema`` (doc_id, text and the
    ``fields`` that queries filter and order by)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, fields: list[str],
                 shards: int = SHARDS, block_docs: int = BLOCK_DOCS):
        self.spark, self.fields, self.shards, self.block_docs = spark, fields, shards, block_docs
        self.schema = T.StructType([schema["doc_id"], *(schema[f] for f in fields), schema["text"]])
        entry = T.StructType([
            schema["doc_id"], T.StructField("positions", T.ArrayType(T.IntegerType())),
            T.StructField("length", T.IntegerType()), *(schema[f] for f in fields)])
        self.postings = Store(spark, f"{path}/postings", T.StructType([
            T.StructField("token", T.StringType()), T.StructField("block", T.LongType()),
            T.StructField("entries", T.ArrayType(entry)), T.StructField("shard", T.IntegerType())]), "shard")
        self.texts = Store(spark, f"{path}/texts", T.StructType(
            [*self.schema, T.StructField("length", T.IntegerType()),
             T.StructField("block", T.LongType())]), "block")
        self.sizes = Store(spark, f"{path}/sizes", "n_docs long, n_tokens long")

    def add(self, docs: DataFrame, batch_id: int) -> None:
        """Index a batch of documents (doc_id, text, fields), each doc_id once
        in all batches. A batch that runs again changes nothing. NULL texts have
        no tokens. Positions are grouped by (token, block), so a frequent
        token's documents are spread over the blocks."""
        docs = docs.select(*self.schema.names)
        blocks = -(-docs.count() // self.block_docs) or 1
        block = F.lit(batch_id << 32) + F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
        d = docs.withColumns({"length": F.size(_words("text")), "block": block.cast("long")})
        # a block's documents lie together by doc_id: a page reads few row groups
        self.texts.append(d.repartition("block").sortWithinPartitions("block", "doc_id"), batch_id)
        stored = self.texts.read(before=batch_id + 1).where(F.col("batch_id") == batch_id).drop("batch_id")
        # texts alone are shuffled: a block's postings are made where its texts are
        doc = ["block", "doc_id", "length", *self.fields]
        each = stored.where(F.col("length") > 0).repartition("block").groupBy(*doc).agg(
            F.collect_list("text").alias("texts"))
        words = each.sortWithinPartitions("block").select(*doc, F.transform("texts", _words).alias("words"))
        workers_find_package(self.spark)
        lists = words.groupBy("block").applyInArrow(_block_postings, T.StructType(
            [self.postings.schema[c] for c in ("token", "block", "entries")]))
        lists = lists.select("token", "block", F.sort_array("entries").alias("entries"),
                             _shard("token", self.shards).alias("shard"))
        self.postings.append(lists.sortWithinPartitions("shard", "token"), batch_id)
        self.sizes.append(stored.agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("n_tokens")), batch_id)

    def entries(self, words: list[str]) -> DataFrame:
        """token, block and the entry's columns for the postings of ``words``;
        only their tokens' folders are read."""
        words = sorted({w.lower() for w in words})
        shards = [r[0] for r in self.spark.createDataFrame([(w,) for w in words], "w string")
                  .select(_shard("w", self.shards)).distinct().collect()]
        p = self.postings.read(values=shards).where(F.col("token").isin(words))
        return p.select("token", "block", F.inline("entries"))

    def matching(self, must: list[str], exact: dict | None = None) -> DataFrame:
        """block, doc_id, fields, hits and score (BM25) of the documents that
        hold all of ``must`` and whose fields equal ``exact``. Document
        frequencies count over the whole index. No text is read."""
        words = sorted({w.lower() for w in must})
        e = self.entries(words)
        size = self.sizes.read().agg(F.sum("n_docs").alias("n"), F.sum("n_tokens").alias("t")).first()
        n, mean = size.n or 0, (size.t or 0) / max(size.n or 0, 1)
        df = {r.token: r["count"] for r in e.groupBy("token").count().collect()}   # a row per word
        idf = reduce(lambda c, w: c.when(F.col("token") == w, F.log(
            F.lit(1 + (n - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5)))), words[1:], F.when(
                F.col("token") == words[0], F.log(F.lit(
                    1 + (n - df.get(words[0], 0) + 0.5) / (df.get(words[0], 0) + 0.5)))))
        for col, val in (exact or {}).items():
            e = e.where(F.col(col) == val)
        tf = F.size("positions")
        part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
        found = e.groupBy("block", "doc_id", *self.fields).agg(
            F.count(F.lit(1)).alias("_n"), F.sum(tf).cast("int").alias("hits"), F.sum(part).alias("score"))
        return found.where(F.col("_n") == len(words)).drop("_n")

    def search(self, must: list[str], exact: dict | None = None, size: int = 20, offset: int = 0,
               order_by: list[Column] | None = None) -> DataFrame:
        """One page: doc_id, fields, hits, score, rank and highlight (of the
        words, in turn), ordered by ``order_by`` (default: relevance, then
        doc_id). The page's ids, at most ``size``, are known before the texts
        are read, so only their blocks' folders and row groups are."""
        order = order_by or [F.desc("score"), F.asc("doc_id")]
        hits = self.matching(must, exact).orderBy(*order).limit(offset + size)
        page = [r for r in hits.collect()][offset:]
        kept = T.StructType([T.StructField("rank", T.IntegerType()), *(hits.schema[c] for c in (
            "block", "doc_id", "hits", "score"))])
        ranks = self.spark.createDataFrame(
            [(i, r.block, r.doc_id, r.hits, r.score) for i, r in enumerate(page, offset + 1)], kept)
        texts = self.texts.read(values=sorted({r.block for r in page})).where(
            F.col("doc_id").isin([r.doc_id for r in page]))
        marked = reduce(lambda c, w: highlight(c, w), must, F.col("text"))
        return (texts.join(F.broadcast(ranks), ["block", "doc_id"])
                .select("doc_id", *self.fields, "hits", "score", "rank", marked.alias("highlight")))
