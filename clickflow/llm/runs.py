"""Periodic runs of words, found by suffix trees.

A run is a longest stretch of words that repeats with its smallest period. By
the runs theorem each has a Lyndon root: at some position, in the order of the
words or in its reverse, the longest Lyndon word starting there is as long as
the run's period. So per order and position there is one candidate, from the
position to the next smaller suffix; how far it extends to both sides are two
longest common extensions. Ukkonen trees of the words and of their reversal
answer these in constant time: the depth of the lowest common ancestor is the
smallest depth between two leaves of the Euler tour.

A run of three periods or more holds each of its words three times or more, and
a word that extends it is one of them. So a word that occurs less often in a text
cuts it into parts that are searched apart, without losing or shortening any
run. The same holds inside each part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickflow.llm.flat import release_memory
from clickflow.llm.sqltext import ready_workers

MIN_LENGTH = 24
MIN_PERIODS = 3
CUTS = 8    # times that parts are cut again; what is left is searched as it is
_BLOCK = 16


class Tree:
    """Suffix tree of ``text`` (numbers from 1 up), which it ends with 0."""

    def __init__(self, text: list[int]):
        self.text = text = [*text, 0]
        self.size = size = max(text) + 1
        n = len(text)
        start, stop, link = [0], [0], [0]     # of the edge into a node
        to: dict[int, int] = {}               # node * size + first number: child
        node = edge = length = left = 0
        for i, c in enumerate(text):
            left += 1
            fresh = 0     # inner node that waits for its suffix link
            while left:
                if not length:
                    edge = i
                key = node * size + text[edge]
                child = to.get(key)
                if child is None:
                    to[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    span = stop[child] - start[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    at = start[child] + length
                    if text[at] == c:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    inner = len(start)
                    start += (start[child], i)
                    stop += (at, n)
                    link += (0, 0)
                    to[key] = inner
                    start[child] = at
                    to[inner * size + text[at]] = child
                    to[inner * size + c] = inner + 1
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        keys = np.fromiter(to.keys(), np.int64, len(to))
        kids = np.fromiter(to.values(), np.int64, len(to))
        order = np.argsort(keys)
        self.children = kids[order].tolist()
        nodes = len(start)
        parents = keys[order] // size
        self.from_ = np.searchsorted(parents, np.arange(nodes)).tolist()
        self.to_ = np.searchsorted(parents, np.arange(nodes), side="right").tolist()
        self.ended = (keys[order] % size == 0).tolist()
        self.spans = (np.array(stop) - np.array(start)).tolist()

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """(depths along the Euler tour, place of each suffix's leaf in it)."""
        n = len(self.text)
        children, lo, hi, spans = self.children, self.from_, self.to_, self.spans
        depth = [0] * len(spans)
        tour, place = [], [0] * n
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            if lo[v] == hi[v]:
                place[n - d] = len(tour)
            else:
                back = ~v
                for c in children[hi[v] - 1:lo[v] - 1 if lo[v] else None:-1]:
                    depth[c] = d + spans[c]
                    stack.append(back)
                    stack.append(c)
            tour.append(d)
        return np.array(tour, dtype=np.int32), np.array(place)

    def reverse_ranks(self) -> list[int]:
        """Ranks of the suffixes under the reversed order of the words, in
        which a prefix still comes before what it begins."""
        n = len(self.text)
        children, lo, hi, spans, ended = (self.children, self.from_, self.to_, self.spans,
                                          self.ended)
        rank, at = [0] * n, 0
        stack = [(0, 0)]
        while stack:
            v, d = stack.pop()
            a, b = lo[v], hi[v]
            if a == b:
                rank[n - d] = at
                at += 1
                continue
            last = ended[a]    # the end mark is the first child in both orders
            for c in children[a + 1 if last else a:b]:
                stack.append((c, d + spans[c]))
            if last:
                c = children[a]
                stack.append((c, d + spans[c]))
        return rank


class Extensions:
    """Longest common extensions of a text's suffixes, in constant time: the
    smallest value of a range from blocks' prefixes and suffixes and a table
    over whole blocks."""

    def __init__(self, tour: np.ndarray, place: np.ndarray):
        self.place = place
        blocks = -(-len(tour) // _BLOCK) + 1
        v = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        v[:len(tour)] = tour
        self.values = v
        grid = v.reshape(blocks, _BLOCK)
        self.head = np.minimum.accumulate(grid, axis=1).ravel()
        self.tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes i and j != i."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        p, q = a // _BLOCK, b // _BLOCK
        out = np.minimum(self.tail[a], self.head[b])
        same = np.flatnonzero(p == q)
        if len(same):
            x, y = a[same], b[same]
            m = self.values[x]
            for s in range(1, _BLOCK):
                m = np.minimum(m, self.values[np.minimum(x + s, y)])
            out[same] = m
        far = np.flatnonzero(q - p > 1)
        if len(far):
            x, y = p[far] + 1, q[far]
            level = np.frexp((y - x).astype(np.float64))[1] - 1
            for k in np.unique(level):
                r = np.flatnonzero(level == k)
                t = self.levels[k]
                m = np.minimum(t[x[r]], t[y[r] - (1 << int(k))])
                out[far[r]] = np.minimum(out[far[r]], m)
        return out


def next_smaller(rank: list[int], n: int) -> np.ndarray:
    """Of each position below n the next one with a smaller suffix, or n."""
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out)


def runs_of(text: list[int], min_length: int = MIN_LENGTH,
            min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers from 1
    up, by start, then period."""
    n = len(text)
    if n < min_length:
        return []
    tree = Tree(text)
    tour, place = tree.tour()
    up = place.tolist()        # leaves stand in the order of the suffixes
    down = tree.reverse_ranks()
    del tree
    ahead = Extensions(tour, place)
    i = np.concatenate([np.arange(n), np.arange(n)])
    j = np.concatenate([next_smaller(up, n), next_smaller(down, n)])
    p = j - i
    keep = np.flatnonzero(p * min_periods <= n)
    i, j, p = i[keep], j[keep], p[keep]
    right = ahead.of(i, j)     # the end mark at n differs from all words
    del ahead
    # what cannot reach the periods to both sides needs no look back
    keep = np.flatnonzero(i + p + right >= np.maximum(min_length, min_periods * p))
    i, j, p, right = i[keep], j[keep], p[keep], right[keep]
    left = np.zeros(len(i), dtype=np.int64)
    inner = np.flatnonzero(i > 0)
    if len(inner):
        back = Extensions(*Tree(text[::-1]).tour())
        left[inner] = back.of(n - i[inner], n - j[inner])
    length = p + left + right
    keep = length >= np.maximum(min_length, min_periods * p)
    found = set(zip((i - left)[keep].tolist(), length[keep].tolist(), p[keep].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def parts(words: list[bytes], min_length: int = MIN_LENGTH,
          min_periods: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """Ranges of words outside of which there is no run."""
    done, todo = [], [(0, len(words))]
    for _ in range(CUTS):
        again = []
        for lo, hi in todo:
            part = words[lo:hi]
            counts = Counter(part)
            rare = {w for w, c in counts.items() if c < min_periods}
            if not rare:
                done.append((lo, hi))
                continue
            last = lo - 1
            for at in [k for k, w in enumerate(part, lo) if w in rare]:
                if at - last > min_length:
                    again.append((last + 1, at))
                last = at
            if hi - last > min_length:
                again.append((last + 1, hi))
        todo = again
        if not todo:
            break
    return sorted(done + todo)


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """The runs of a text's words."""
    out = []
    for lo, hi in parts(words, min_length, min_periods):
        numbers: dict[bytes, int] = {}
        text = [numbers.setdefault(w, len(numbers) + 1) for w in words[lo:hi]]
        out += [(lo + s, m, q) for s, m, q in runs_of(text, min_length, min_periods)]
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, exactly; then the first, then the shortest."""
    best = None
    for r in runs:      # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without each run's repetitions of its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for s, m, q in runs:
        cover[s + q] += 1
        cover[s + m] -= 1
    cover = np.cumsum(cover)
    return [w for w, c in zip(words, cover.tolist()) if not c]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then
    period), ``best`` (the run of most periods, NULL without runs) and
    ``text`` with the repetitions taken out and one blank between words, for
    every row of ``docs`` (doc_id, text).

    Words are the runs of bytes other than ASCII blanks. NULL and empty texts
    have no words and no runs; repeated rows and NULL ids give rows of their
    own; other columns are ignored. ``min_periods`` is 2 or more. A text is
    searched whole, by one task; the trees take some 500 bytes a word of the
    parts that need them.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def structs(rows: list) -> list:
        return [None if r is None else dict(zip(("start", "length", "period"), r)) for r in rows]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, all_runs, best, texts = [], [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                runs = word_runs(words, min_length, min_periods)
                n_words.append(len(words))
                all_runs.append(structs(runs))
                best.append(best_run(runs))
                texts.append(b" ".join(collapsed(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(all_runs, pa.list_(run)),
                 pa.array(structs(best), run), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "best", "text"])
        release_memory()

    ready_workers(docs.sparkSession)
    one = "struct<start: long, length: long, period: long>"
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        f"n_words long, runs array<{one}>, best {one}, text string").fields])
    return docs.select("doc_id", "text").mapInArrow(find, schema)
