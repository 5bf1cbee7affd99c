"""Byte-pair encoding by a table of distinct words, and decoding.

The tokenizer never merges across blanks, so a text's ids are those of its
blank-separated words in a row, and each distinct word needs encoding once.

1. Documents are cut into blocks of bounded size. A block has its distinct
   words, dealt into parts by their hash (``block_words``), and its documents
   as numbers of words (``block_texts``).
2. The table of distinct words is spread over the parts: all blocks' words of
   a part meet in one task, which encodes each of them once and answers every
   block (``encode_parts``).
3. A block's documents meet its words' ids and are put together by position;
   ids become text by way of the id-to-piece table (``encode``). The table
   has as many rows as the vocabulary, so tasks hold it; ``decode_ids`` is the
   same as a Spark join, for ids that come without their words.

What is shuffled is packed: the blocks' vocabularies once each way and the
documents' numbers, about half of the texts' size, and no text. A word of every
block is one entry a block, however often it stands there. The documents are
read and split twice, which costs less than keeping the blocks in between; both
times they must come in the same order, so documents that are not a table's are
written to one first, and a block that differs is an error.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.flat import release_memory
from clickflow.llm.sqltext import ready_workers, save_shared

BLOCK_BYTES = 1 << 23    # text of a block, at least (but for a task's last one)
PARTS = 256              # of the table of distinct words
REMEMBERED = 1_000_000   # words whose ids a task remembers; beyond that it starts anew


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed planes of bytes."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(4, "little") + (
        pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    if not n:
        return np.zeros(0, dtype=np.int64)
    planes = np.frombuffer(pa.decompress(data[4:], 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


class Block:
    """Documents' words: ``words``, the frequent ones first; ``codes``, all
    documents' words as their numbers; ``lengths``, words of each document;
    ``deal``, the part of each word."""

    def __init__(self, texts: list[pa.Array], parts: int):
        lists = pc.ascii_split_whitespace(
            pc.fill_null(pa.concat_arrays(texts).cast(pa.large_string()), ""))
        coded = lists.flatten().dictionary_encode()
        found = coded.indices.to_numpy()
        order = np.argsort(-np.bincount(found, minlength=len(coded.dictionary)), kind="stable")
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        self.codes, self.lengths = number[found], np.diff(lists.offsets.to_numpy())
        self.words = coded.dictionary.take(pa.array(order)).cast(pa.large_binary()).to_pylist()
        self.deal = np.fromiter(map(zlib.crc32, self.words), np.int64, len(order)) % parts

    def by_part(self) -> Iterator[tuple[int, bytes]]:
        """(part, its words in the order of their numbers, joined)."""
        order = np.argsort(self.deal, kind="stable")
        at = np.flatnonzero(np.diff(self.deal[order], prepend=-1))
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(order)]):
            yield int(self.deal[order[lo]]), b"\n".join(map(self.words.__getitem__, order[lo:hi].tolist()))


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int, parts: int
            ) -> Iterator[tuple[int, pa.Array, Block]]:
    """(number, doc_ids, block) of a task's documents. Numbers follow from the
    task's number and the rows' order, so a task that runs again gives the
    same."""
    number = TaskContext.get().partitionId() << 33
    ids, texts, size = [], [], 0
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy()
        ends, lo = np.cumsum(lengths), 0
        while lo < b.num_rows:
            done = int(ends[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(ends, done + block_bytes - size)) + 1, b.num_rows)
            ids.append(b.column(0)[lo:hi])
            texts.append(b.column(1)[lo:hi])
            size += int(ends[hi - 1]) - done
            lo = hi
            if size >= block_bytes:
                yield number, pa.concat_arrays(ids), Block(texts, parts)
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield number, pa.concat_arrays(ids), Block(texts, parts)


def block_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, parts: int = PARTS) -> DataFrame:
    """One row a block: block, doc_ids, and packed ``lengths``, ``codes``,
    ``deal`` (see ``Block``) and ``sums``, a checksum of each part's words."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("lengths", T.BinaryType()), T.StructField("codes", T.BinaryType()),
        T.StructField("deal", T.BinaryType()), T.StructField("sums", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, block in _blocks(batches, block_bytes, parts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *(pa.array([pack(x)], pa.binary()) for x in (
                     block.lengths, block.codes, block.deal,
                     np.array([zlib.crc32(x) for _, x in block.by_part()], dtype=np.int64)))],
                schema.names)
        release_memory()

    ready_workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def block_words(docs: DataFrame, block_bytes: int = BLOCK_BYTES, parts: int = PARTS) -> DataFrame:
    """One row for each part that a block has words of: block, part, size and
    packed ``words``, in the order of their numbers."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, block in _blocks(batches, block_bytes, parts):
            found = [(p, len(x), pa.compress(x, codec="zstd", asbytes=True)) for p, x in block.by_part()]
            part, size, words = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(found), pa.int64()), pa.array(part, pa.int32()),
                 pa.array(size, pa.int32()), pa.array(words, pa.binary())],
                ["block", "part", "size", "words"])
        release_memory()

    ready_workers(docs.sparkSession)
    # the ids take part so that both reads of a table are cut into the same tasks
    return docs.select("doc_id", "text").mapInArrow(
        cut, "block long, part int, size int, words binary")


def encode_parts(words: DataFrame, tokenizer_path: str, remembered: int = REMEMBERED) -> DataFrame:
    """(of_block, part, counts, ids, sum) of rows (block, part, size, words): the ids
    of a block's words of a part, in their order. Rows of a part meet in one
    task, so a word is encoded once for all blocks (again only where a task has
    met more than ``remembered`` words since)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(tokenizer_path)
        tok.no_padding()
        tok.no_truncation()
        known: dict[str, bytes] = {}
        for b in batches:
            counts, ids, sums = [], [], []
            for size, data in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                text = pa.decompress(data, size, codec="zstd", asbytes=True)
                words = text.decode().split("\n")     # no word holds a line end
                sums.append(zlib.crc32(text))
                new = [w for w in words if w not in known]
                for w, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False)):
                    known[w] = array("I", e.ids).tobytes()
                found = [known[w] for w in words]
                counts.append(pack(np.fromiter(map(len, found), np.int64, len(found)) // 4))
                ids.append(pack(np.frombuffer(b"".join(found), np.uint32)))
                if len(known) > remembered:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counts, pa.binary()), pa.array(ids, pa.binary()),
                 pa.array(sums, pa.int64())], ["of_block", "part", "counts", "ids", "sum"])
        release_memory()

    ready_workers(words.sparkSession)
    return (words.select("block", "part", "size", "words").repartition("part")
            .mapInArrow(run, "of_block long, part int, counts binary, ids binary, sum long"))


def id_to_piece(spark: SparkSession, tokenizer_path: str) -> DataFrame:
    """(id, piece) of a tokenizer file, special tokens included: as many rows
    as its vocabulary has."""
    from tokenizers import Tokenizer
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(pa.table({
        "id": pa.array(vocabulary.values(), pa.int32()), "piece": pa.array(vocabulary.keys())}))


def decode_ids(encoded: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """``encoded`` (key, ids; each key once) with ``decoded``: the pieces of its
    ids by position, one blank between two, as a tokenizer without a decoder
    gives them. No ids decode to an empty text, unknown ids to nothing."""
    each = encoded.select(key, F.posexplode("ids").alias("_at", "id"))
    # the vocabulary bounds this side
    found = (each.join(F.broadcast(pieces), "id").groupBy(key)
             .agg(F.array_sort(F.collect_list(F.struct("_at", "piece"))).alias("_p")))
    text = F.array_join(F.transform("_p", lambda p: p["piece"]), " ")
    return encoded.join(found, key, "left").select(
        key, "ids", F.coalesce(text, F.lit("")).alias("decoded"))


def encode(docs: DataFrame, tokenizer_path: str, block_bytes: int = BLOCK_BYTES,
           parts: int = PARTS, remembered: int = REMEMBERED,
           replayable: bool = False) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text): the ids of
    the whole text by a word-level BPE file (whose pre-tokenizer splits at
    blanks), without special tokens around them, and their decoding, special
    tokens kept.

    NULL and empty texts have no ids and decode to an empty text. Repeated rows
    and NULL ids give rows of their own; other columns are ignored. A document
    is never cut: one longer than a block is a block of its own. ``replayable``
    says that ``docs`` are rows of a table, which come in the same order when
    they are read again; others are written to one.
    """
    docs = docs.select("doc_id", "text")
    if not replayable:
        docs = save_shared(docs, "bpe-documents")
    known = encode_parts(block_words(docs, block_bytes, parts), tokenizer_path, remembered)
    texts = block_texts(docs, block_bytes, parts)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        block = {c: left[c][0] for c in left.column_names}
        right = right.sort_by("part")
        # ids of the words in the order of the parts, then of their numbers
        order = np.argsort(unpack(block["deal"].as_py()), kind="stable")
        found = [unpack(x) for x in right["ids"].to_pylist()]
        flat = np.concatenate([np.zeros(0, dtype=np.int64), *found])
        dealt = np.concatenate([np.zeros(0, dtype=np.int64),
                                *(unpack(x) for x in right["counts"].to_pylist())])
        if unpack(block["sums"].as_py()).tolist() != right["sum"].to_pylist():
            raise RuntimeError("the documents came differently when read again")
        ends = np.cumsum(dealt)
        counts, starts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        counts[order], starts[order] = dealt, ends - dealt
        piece = _pieces(tokenizer_path)
        spelt = list(map(piece.__getitem__, flat.tolist()))
        decoded = [" ".join(spelt[a:a + n]) for a, n in zip(starts.tolist(), counts.tolist())]
        codes = unpack(block["codes"].as_py())
        out_ids, out_text, lo = [], [], 0
        for length in unpack(block["lengths"].as_py()).tolist():
            at = codes[lo:lo + length]
            lo += length
            at = at[counts[at] > 0]
            n = counts[at]
            out_ids.append(flat[np.repeat(starts[at] - (np.cumsum(n) - n), n)
                                + np.arange(n.sum())].astype(np.int32))
            out_text.append(" ".join(map(decoded.__getitem__, at.tolist())))
        return pa.table({"doc_id": block["doc_ids"].values, "ids": pa.array(out_ids, pa.list_(pa.int32())),
                         "decoded": pa.array(out_text, pa.string())})

    return texts.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(put_together, schema)


_piece_lists: dict[str, list[str]] = {}


def _pieces(tokenizer_path: str) -> list[str]:
    """The id-to-piece table in a worker process, once a file."""
    if tokenizer_path not in _piece_lists:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(tokenizer_path)
        vocabulary = tok.get_vocab(with_added_tokens=True)
        pieces = [""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, i in vocabulary.items():
            pieces[i] = piece
        _piece_lists[tokenizer_path] = pieces
    return _piece_lists[tokenizer_path]
