"""Hierarchical multi-length packing of tokenised documents.

Documents are cut into full windows of the longest length; what remains is
routed to the tier (context length) it fits. Tiers are packed from long to
short: the longest remainder opens a window of its tier, shorter remainders
fill the gap, and the last of them is cut where the window ends, so windows
have no padding. Each input partition is packed on its own in bounded blocks,
which needs no shuffle; only its last window may stay open. Windows of a tier
are numbered over all partitions, by the partitions' counts, and dealt into step
groups of equal token counts.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.flat import release_memory
from clickflow.llm.sqltext import ready_workers, save_shared

TIERS = (2048, 1024, 512, 256)
END_ID = 1
BLOCK_TOKENS = 1 << 18     # tokens packed together, at least (one document more at most)
STEP_TOKENS = 1 << 16      # tokens of a step group
REMEMBERED = 600_000       # blank-separated chunks whose ids a worker remembers (half
                           # as many pieces of chunks): about 250 bytes each
TEXT_BATCH = 1 << 22       # characters tokenised together, at most

# Characters whose lower case and class are the same for the tokenizer's
# normaliser and for Python: ASCII (but four control characters that only
# Python takes for blanks) and the Latin-1 letters.
_ODD = re.compile("[^\x00-\x1b\x20-\x7fÀ-ÿ]")
_SPECIAL = "<|"
_LETTER = "a-zß-öø-ÿ"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\x20\x09-\x0d{_LETTER}0-9]+")
_BLANKS = re.compile("[\x20\x09-\x0d]+")


class IdStore:
    """Ids of remembered strings, in one flat array. At most ``most`` strings
    (and those of one batch) are kept; beyond that the later half goes, as the
    frequent ones are met first."""

    def __init__(self, most: int):
        self.most = most
        self.index: dict[str, int] = {}
        self.start = np.zeros(1 << 16, dtype=np.int32)
        self.size = np.zeros(1 << 16, dtype=np.int32)
        self.flat = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.index), len(self.index) + len(strings)
        while m > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.size[n:m] = sizes
        self.start[n:m] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.index.update(zip(strings, range(n, m)))

    def ids(self, at: np.ndarray | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings in a row, number of ids of each); strings may be
        given by their numbers."""
        if isinstance(at, list):
            at = np.fromiter(map(self.index.__getitem__, at), np.int64, len(at))
        starts, sizes = self.start[at], self.size[at]
        ends = np.cumsum(sizes, dtype=np.int32)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - (ends - sizes), sizes)
                         + np.arange(total, dtype=np.int32)], sizes

    def trim(self) -> None:
        if len(self.index) > self.most:
            n = self.most // 2
            self.index = dict(islice(self.index.items(), n))
            self.used = int(self.start[n - 1] + self.size[n - 1])


class WordTokenizer:
    """Ids of whole texts by a word-level BPE file.

    The tokenizer never merges across blanks or between its pieces, so a
    text's ids are those of its blank-separated chunks in a row, and a chunk's
    those of its pieces. Both are remembered, up to a bound. Chunks with
    characters whose treatment could differ are encoded as they stand, texts
    with a special token in them as a whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        ends = np.zeros(self.tok.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tok.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends = ends
        self.chunks, self.pieces = IdStore(remembered), IdStore(remembered // 2)

    def _whole(self, text: str) -> np.ndarray:
        # the fast form skips offsets, which nothing here needs
        found = self.tok.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, dtype=np.uint32)

    def _each(self, store: IdStore, strings: list[str]) -> None:
        if strings:
            ids = [self._whole(x) for x in strings]
            store.add(strings, np.concatenate(ids), np.array([len(x) for x in ids]))

    def _learn(self, plain: list[str]) -> None:
        """Remember chunks of plain characters by way of their pieces, which go
        to the tokenizer many at a time."""
        lists = [_PIECE.findall(c) for c in plain]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        pieces = list(chain.from_iterable(lists))
        known = self.pieces.index
        new = [p for p in set(pieces) if p not in known]
        for lo in range(0, len(new), 5000):
            part = new[lo:lo + 5000]
            ids = self._whole(" ".join(part))
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(part):   # one word end a piece
                self.pieces.add(part, ids, np.diff(stop, prepend=0))
            else:
                self._each(self.pieces, part)
        ids, sizes = self.pieces.ids(pieces)
        self.chunks.add(plain, ids, _sums(sizes, counts))
        self.pieces.trim()

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of plain characters. Arrow cuts them at blanks and
        numbers the distinct chunks, so only those are looked up."""
        lists = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        at = list(map(self.chunks.index.get, chunks))
        new = [i for i, a in enumerate(at) if a is None]
        if new:
            self._learn([chunks[i] for i in new])
            n = len(self.chunks.index) - len(new)
            for i in new:
                at[i] = n
                n += 1
        ids, sizes = self.chunks.ids(np.array(at, dtype=np.int64)[coded.indices.to_numpy()])
        counts = np.diff(lists.offsets.to_numpy())
        return np.split(ids, np.cumsum(_sums(sizes, counts))[:-1])

    def _odd(self, text: str) -> np.ndarray:
        """Ids of a text with other characters, cut at ASCII blanks."""
        chunks = [x for x in _BLANKS.split(text) if x]
        known = self.chunks.index
        self._each(self.chunks, [c for c in dict.fromkeys(chunks) if c not in known])
        return self.chunks.ids(chunks)[0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, without special tokens around it."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if _SPECIAL in t:
                out[i] = self._whole(t)
            elif _ODD.search(t):
                out[i] = self._odd(t)
            else:
                plain.append(i)
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain])):
                out[i] = ids
        self.chunks.trim()
        return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values."""
    total = np.concatenate(([0], np.cumsum(values)))
    return np.diff(total[np.cumsum(counts)], prepend=0)


_tokenizers: dict[tuple[str, int], WordTokenizer] = {}


def tokenizer(path: str, remembered: int = REMEMBERED) -> WordTokenizer:
    """One tokenizer a worker process, file and size."""
    key = (path, remembered)
    if key not in _tokenizers:
        _tokenizers[key] = WordTokenizer(path, remembered)
    return _tokenizers[key]


@dataclass
class Piece:
    """``size`` ids of document ``doc`` from ``start`` on."""
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Packer:
    """Packs one partition's documents. ``add`` and ``finish`` yield windows:
    (tier, pieces)."""
    tiers: tuple[int, ...] = TIERS
    pool: list[tuple[int, int]] = field(default_factory=list)   # (size, slot), sorted
    items: dict[int, Piece] = field(default_factory=dict)
    slots: int = 0
    tokens: int = 0

    def _put(self, p: Piece) -> None:
        self.items[self.slots] = p
        insort(self.pool, (len(p.ids), self.slots))
        self.slots += 1
        self.tokens += len(p.ids)

    def _take(self, i: int) -> Piece:
        size, slot = self.pool.pop(i)
        self.tokens -= size
        return self.items.pop(slot)

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple[int, list[Piece]]]:
        top = self.tiers[0]
        full = len(ids) // top * top
        for at in range(0, full, top):
            yield top, [Piece(doc, at, ids[at:at + top], len(ids))]
        if full < len(ids):
            self._put(Piece(doc, full, ids[full:], len(ids)))

    def flush(self) -> Iterator[tuple[int, list[Piece]]]:
        """Windows from the pool until only one open window's pieces are left,
        which stay in the pool."""
        while self.pool:
            size = self.pool[-1][0]
            tier = min(t for t in self.tiers if t >= size)
            if self.tokens < tier:
                return
            window = [self._take(len(self.pool) - 1)]
            gap = tier - size
            while gap:
                i = bisect_right(self.pool, (gap, self.slots)) - 1
                p = self._take(max(i, 0))
                if i < 0:   # the shortest remainder is cut at the window's end
                    self._put(Piece(p.doc, p.start + gap, p.ids[gap:], p.doc_tokens))
                    p = Piece(p.doc, p.start, p.ids[:gap], p.doc_tokens)
                window.append(p)
                gap -= len(p.ids)
            yield tier, window

    def finish(self) -> Iterator[tuple[int, list[Piece]]]:
        """Everything left: windows of shorter and shorter tiers, then a last
        one that is not full."""
        yield from self.flush()
        for tier in self.tiers:
            while self.tokens >= tier:
                window, gap = [], tier
                while gap:
                    p = self._take(len(self.pool) - 1)
                    if len(p.ids) > gap:
                        self._put(Piece(p.doc, p.start + gap, p.ids[gap:], p.doc_tokens))
                        p = Piece(p.doc, p.start, p.ids[:gap], p.doc_tokens)
                    window.append(p)
                    gap -= len(p.ids)
                yield tier, window
        if self.pool:
            yield self.tiers[-1], [self._take(len(self.pool) - 1) for _ in range(len(self.pool))]


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, tier int")


def pack_documents(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS,
                   with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, and with
    ``with_ids`` the ids themselves. ``remembered`` trades a worker's memory for
    its speed.

    A document's ids end with ``END_ID``; a NULL or empty text has that id
    alone. Repeated rows are packed as rows of their own, a NULL doc_id stays
    NULL. Sequence and group numbers are unique over all partitions and follow
    from the partition's rows, so a task that runs again gives the same. Every
    group but the last of each tier holds windows of ``STEP_TOKENS`` tokens. The
    pieces are written to the shared folder first, as the groups follow from
    the number of windows in all partitions.
    """
    fields = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(),
              "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(),
              "offset": pa.int64(), "tier": pa.int32(), "part": pa.int32(), "nth": pa.int64()}
    if with_ids:
        fields["ids"] = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok, packer = tokenizer(tokenizer_path, remembered), Packer(tiers)
        part = TaskContext.get().partitionId()
        base = part << 33
        rows: list[tuple] = []
        seqs, by_tier = 0, dict.fromkeys(tiers, 0)

        def write(windows: Iterator[tuple[int, list[Piece]]]) -> None:
            nonlocal seqs
            for tier, window in windows:
                offset = 0
                for p in window:
                    n = len(p.ids)
                    crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                    row = (p.doc, p.start, n, crc, p.doc_tokens, base + seqs, offset, tier, part,
                           by_tier[tier])
                    rows.append((*row, p.ids.astype(np.int32)) if with_ids else row)
                    offset += n
                by_tier[tier] += 1
                seqs += 1

        def emit() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[] for _ in fields]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, fields.values())], list(fields))

        def pack(docs: list[int | None], texts: list[str]) -> None:
            for doc, t in zip(docs, tok.encode(texts)):
                write(packer.add(doc, np.append(t, np.uint32(END_ID))))
                if packer.tokens >= BLOCK_TOKENS:
                    write(packer.flush())

        batch = min(TEXT_BATCH, 10 * remembered)
        docs, texts, size = [], [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                docs.append(doc)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= batch:
                    pack(docs, texts)
                    docs, texts, size = [], [], 0
            if len(rows) >= 5000:
                yield emit()
        pack(docs, texts)
        write(packer.finish())
        yield emit()
        release_memory()

    ready_workers(docs.sparkSession)
    schema = f"{PIECES}, part int, nth long" + (", ids array<int>" if with_ids else "")
    pieces = save_shared(docs.select("doc_id", "text").mapInArrow(run, schema), "packed-pieces")
    return with_step_groups(pieces, tiers)


def with_step_groups(pieces: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """``pieces`` with ``step_group`` for ``part`` (partition) and ``nth`` (window of
    its tier there): windows are numbered over all partitions by a running sum
    of the partitions' counts, a row per partition and tier."""
    counts = pieces.groupBy("tier", "part").agg((F.max("nth") + 1).alias("windows"))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("tier", "part", F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("earlier"))
    size = F.greatest(F.floor(F.lit(STEP_TOKENS) / F.col("tier")), F.lit(1))
    group = F.floor((F.col("earlier") + F.col("nth")) / size) * len(tiers) + F.array_position(
        F.array(*[F.lit(t) for t in tiers]), F.col("tier")) - 1
    columns = [c for c in pieces.columns if c not in ("part", "nth")]
    at = columns.index("tier") + 1
    return pieces.join(start, ["tier", "part"]).select(
        *columns[:at], group.cast("long").alias("step_group"), *columns[at:])
