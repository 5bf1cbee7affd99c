"""Near-duplicate documents by a chosen-path set similarity join.

Equal shingle sets are one class. Every tree sends a class down a path of
selected minwise tokens, so two classes of similarity s share the node at the
path's end with probability s ** path; the number of independent trees follows
from the wanted recall. Classes that share nodes form clusters. A small cluster
is compared exhaustively. A large one branches again: all members are compared
with its pivot, and then by the tokens in which they differ from the pivot.
Members that the pivot does not link must share one of the first of those
tokens with any partner, so this branching loses nothing. All similarities are
confirmed on full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.components import connected_components
from clickflow.llm.flat import Flat, as_bytes, chunks, mix, release_memory
from clickflow.llm.sqltext import ready_workers, save_shared

MISS = 1e-5            # chance that no tree joins a pair right at the threshold
CLUSTER = 32           # classes compared exhaustively,
CLUSTER_TOKENS = 1 << 22   # and their shingles in all
BLOCK = 2_000          # members of one side of a compared block in a large cluster,
BLOCK_TOKENS = 1 << 20     # and their differences in all
PATH = 4               # tokens of a path, at least
STRANGERS = 1 / 200    # similarity of unrelated documents
BROADCAST_ROWS = 500_000   # row keys in a broadcast, at most

_U = np.uint64


def path_length(n_docs: int) -> int:
    """Tokens of a path, so that unrelated documents seldom meet: the expected
    number of strangers in a node stays below one in a hundred."""
    return max(PATH, math.ceil(math.log(max(n_docs, 1) * 100) / math.log(1 / STRANGERS)))


def trees_for(percent: int, path: int, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** path))


def _minwise(tokens: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the tokens under each of ``n`` hash functions."""
    odd = mix(np.arange(1, n + 1, dtype=np.uint64)) | _U(1)
    turn = mix(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))
    low = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(tokens), 4096):
            t = tokens[None, at:at + 4096]
            np.minimum(low, ((t ^ turn[:, None]) * odd[:, None]).min(axis=1), out=low)
    return low


def path_keys(tokens: np.ndarray, trees: int, path: int) -> np.ndarray:
    """The node of each tree that a token set ends in."""
    sig = _minwise(tokens.view(np.uint64), trees * path).reshape(trees, path)
    key = mix(np.arange(trees, dtype=np.uint64) + _U(1 << 20))
    with np.errstate(over="ignore"):
        for level in range(path):
            key = mix(key * _U(3) + sig[:, level])
    return key


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted signed longs."""
    for lo, hi in chunks(texts):
        f = Flat(texts[lo:hi])
        d, h = f.shingles(k)
        at = np.searchsorted(d, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield np.unique(h[at[i]:at[i + 1]].view(np.int64))


def _fingerprint(tokens: np.ndarray) -> str:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else ""


def row_key(doc_id: Column, text: Column) -> Column:
    """The same for equal rows, whichever scan reads them."""
    return F.xxhash64(doc_id, text)


def second_key(doc_id: Column, text: Column) -> Column:
    """Another 64 bits of a row, for what is decided by its key alone."""
    return F.xxhash64(F.lit("second"), text, doc_id)


def sketch(docs: DataFrame, k: int, trees: int, path: int) -> DataFrame:
    """doc_id, rk and rk2 (row key), n (set size), fp (set fingerprint, '' for an empty
    set) and keys (node per tree) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, keys = [], [], []
            for s in _sets(as_bytes(b.column(3)), k):
                n.append(len(s))
                fp.append(_fingerprint(s))
                keys.append(path_keys(s, trees, path).view(np.int64) if len(s)
                            else np.empty(0, np.int64))
            at = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(fp, pa.string()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                ["doc_id", "rk", "rk2", "n", "fp", "keys"])
            release_memory()

    key = (F.col("doc_id"), F.col("text"))
    d = docs.select("doc_id", row_key(*key).alias("rk"), second_key(*key).alias("rk2"), "text")
    id_type = dict(d.dtypes)["doc_id"]
    return d.mapInArrow(run, f"doc_id {id_type}, rk long, rk2 long, n long, fp string, keys array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """fp and tokens of the rows of ``docs`` whose row key is in ``wanted`` (rk),
    one row per fp. Keys are broadcast up to ``BROADCAST_ROWS``, beyond that
    joined by a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(_sets(as_bytes(b.column(0)), k))
            at = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_fingerprint(s) for s in sets], pa.string()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["fp", "tokens"])
            release_memory()

    keys = wanted.select("rk").distinct()
    few = wanted.count() <= BROADCAST_ROWS
    d = docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("rk"))
    d = d.join(F.broadcast(keys) if few else keys, "rk", "left_semi")
    return d.select("text").mapInArrow(run, "fp string, tokens array<long>").dropDuplicates(["fp"])


def clusters(classes: DataFrame) -> DataFrame:
    """fp, rk, cluster, small and weight of the classes (fp, rk, n, keys) that
    share a node with another one. ``small`` clusters are within the bounds of
    exhaustive comparison; ``weight`` sums the sizes of a class's nodes."""
    members = classes.select("fp", F.explode("keys").alias("key"))
    nodes = save_shared(members.groupBy("key").agg(
        F.min("fp").alias("hub"), F.count(F.lit(1)).alias("in_node")).where("in_node > 1"),
        "near-nodes", few_files=True)
    held = save_shared(members.join(nodes, "key").select("fp", "hub", "in_node"), "near-members",
                       few_files=True)
    roots = connected_components(held.select(F.col("fp").alias("a"), F.col("hub").alias("b")), "near")
    weight = held.groupBy("fp").agg(F.sum("in_node").alias("weight"))
    c = save_shared(roots.withColumnsRenamed({"node": "fp"}).join(weight, "fp")
                    .join(classes.select("fp", "rk", "n"), "fp"), "near-rooted")
    small = ((F.count(F.lit(1)) <= CLUSTER) & (F.sum("n") <= CLUSTER_TOKENS)).alias("small")
    size = save_shared(c.groupBy("root").agg(small), "near-sizes")
    return c.join(size, "root").select("fp", "rk", F.col("root").alias("cluster"), "small", "weight")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    i = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[i] == a).sum())


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


LINK = "a string, b string"


def _compare_all(percent: int):
    """Links of a small cluster: a spanning set of the similar pairs."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        fp, sets = g["fp"].tolist(), g["tokens"].tolist()
        u, out = _Union(len(fp)), []
        order = sorted(range(len(fp)), key=lambda i: (len(sets[i]), fp[i]))
        for x, i in enumerate(order):
            for j in order[x + 1:]:
                a, b = len(sets[i]), len(sets[j])
                if 100 * a < percent * b:
                    break
                if u.find(i) == u.find(j):
                    continue
                both = _overlap(sets[i], sets[j])
                if 100 * both >= percent * (a + b - both):
                    u.up[u.find(i)] = u.find(j)
                    out.append((fp[i], fp[j]))
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _compare_block(percent: int):
    """Links within a block of members that share a difference token: rows fp, n,
    core, at (the token's position) and diff (sorted differences)."""
    c = (100 - percent) / (100 + percent)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["core", "fp"]).reset_index(drop=True)
        fp, diffs = g["fp"].tolist(), [np.sort(np.asarray(d)) for d in g["diff"]]
        n, at = g["n"].to_numpy(), g["at"].to_numpy()
        size = np.array([len(d) for d in diffs])
        u, out = _Union(len(fp)), []
        for i in range(int((~g["core"].to_numpy(dtype=bool)).sum())):
            # the overlap a link needs, against the most that can follow here
            need = (size[i] + size[i + 1:] - c * (n[i] + n[i + 1:])) / 2
            most = 1 + np.minimum(size[i] - at[i] - 1, size[i + 1:] - at[i + 1:] - 1)
            for j in np.flatnonzero(most >= need - 1e-6) + i + 1:
                if u.find(i) == u.find(j):
                    continue
                apart = size[i] + size[j] - 2 * _overlap(diffs[i], diffs[j])
                both = (n[i] + n[j] - apart) // 2
                if 100 * both >= percent * (n[i] + n[j] - both):
                    u.up[u.find(i)] = u.find(j)
                    out.append((fp[i], fp[j]))
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _large_links(sets: DataFrame, percent: int) -> list[DataFrame]:
    """Links in clusters that are not small: to the pivot, and
    between members that share one of their first differences."""
    pivots = save_shared(sets.groupBy("cluster").agg(
        F.max(F.struct("weight", "fp"))["fp"].alias("fp"))
        .join(sets.select("fp", F.col("tokens").alias("pivot")), "fp")
        .select("cluster", F.col("fp").alias("pivot_fp"), "pivot"), "near-pivots")
    d = sets.join(pivots, "cluster").where("fp <> pivot_fp")
    # differences that the pivot lacks come first; the order is the same for
    # all members of a cluster
    d = d.withColumns({
        "more": F.sort_array(F.array_except("tokens", "pivot")),
        "less": F.sort_array(F.array_except("pivot", "tokens")),
        "n": F.size("tokens"), "np": F.size("pivot")})
    both = F.col("n") - F.size("more")
    d = save_shared(d.select(
        "cluster", "fp", "pivot_fp", "n", F.concat("more", "less").alias("diff"),
        (100 * both >= percent * (F.col("n") + F.col("np") - both)).alias("core")), "near-diffs")
    star = d.where("core").select(F.col("fp").alias("a"), F.col("pivot_fp").alias("b"))

    first = F.floor(F.col("n") * (100 - percent) / percent).cast("int") + 1
    rows = d.select("cluster", "fp", "n", "core", "diff",
                    F.posexplode(F.slice("diff", F.lit(1), first)).alias("at", "token"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("held") / BLOCK_TOKENS))
    shared = save_shared(rows.groupBy("cluster", "token").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.size("diff")).alias("held"),
        F.min("core").alias("all_core")).where("members > 1 and not all_core")
        .select("cluster", "token", blocks.cast("int").alias("blocks")), "near-buckets")
    # a large bucket is compared block against block: every member meets all
    # blocks, each cell holds two of them
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    placed = rows.join(shared, ["cluster", "token"]).withColumn("cell", F.explode(cells))
    links = placed.groupBy("cluster", "token", "cell").applyInPandas(
        lambda g: _compare_block(percent)(g[["fp", "n", "core", "at", "diff"]]), LINK)
    return [star, links]


def duplicate_classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sketch rows, classes): sketch rows are doc_id, rk, rk2, n and fp of every row
    of ``docs``; classes map each fp that is repeated or linked to its root."""
    ready_workers(docs.sparkSession)
    path = path_length(docs.count())
    trees = trees_for(percent, path)
    rows = save_shared(sketch(docs, k, trees, path), "near-sketch", few_files=True)
    classes = save_shared(rows.where("fp <> ''").groupBy("fp").agg(
        F.min("rk").alias("rk"), F.first("keys").alias("keys"), F.max("n").alias("n"),
        F.count(F.lit(1)).alias("copies")),
        "near-classes")
    found = save_shared(clusters(classes), "near-clusters")
    sets = save_shared(found.join(full_sets(docs, found, k), "fp")
                       .select("cluster", "small", "weight", "fp", "tokens"), "near-sets",
                       few_files=True)
    small = sets.where("small")
    parts = [small.select("cluster", "fp", "tokens").groupBy("cluster")
             .applyInPandas(_compare_all(percent), LINK)]
    large = sets.where("not small")
    if not large.isEmpty():
        parts += _large_links(large, percent)
    links = parts[0]
    for p in parts[1:]:
        links = links.unionByName(p)
    roots = connected_components(links, "near-links").withColumnsRenamed({"node": "fp"})
    known = classes.where("copies > 1").select("fp").join(roots, "fp", "full").select(
        "fp", F.coalesce("root", "fp").alias("root"))
    return rows.select("doc_id", "rk", "rk2", "n", "fp"), save_shared(known, "near-roots")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable over links of at least ``percent``
    similarity of the ``k``-word shingle sets) and kept (doc_id is that).

    A text without words is linked with nothing; one of fewer than ``k`` words
    is a single shingle. A NULL doc_id never is the smallest unless all of its
    component are NULL; such rows are kept, NULL ones beside others are not.
    Repeated rows are linked with each other like any copies.
    """
    rows, roots = duplicate_classes(docs, k, percent)
    grouped = rows.join(roots, "fp")
    lowest = save_shared(grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
                         .join(roots, "root").select("fp", "component_id",
                                                     F.lit(True).alias("known")), "near-lowest")
    j = rows.join(lowest, "fp", "left")
    comp = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return j.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                    F.col("doc_id").eqNullSafe(comp).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of the
    smallest doc_id (NULL last). Same columns; texts without words all stay,
    of repeated rows one does."""
    rows, roots = duplicate_classes(docs, k, percent)
    grouped = rows.join(roots, "fp").select("root", F.struct(
        F.col("doc_id").isNull().alias("null_id"), "doc_id", "rk", "rk2").alias("row"))
    first = save_shared(grouped.groupBy("root").agg(F.min("row").alias("first")), "near-first")
    key = ["rk", "rk2"]
    ranked = grouped.join(first, "root").select(*[F.col("row")[c].alias(c) for c in key], (
        (F.col("row")["rk"] == F.col("first")["rk"])
        & (F.col("row")["rk2"] == F.col("first")["rk2"])).alias("keep"))
    ranked = ranked.groupBy(*key, "keep").agg(F.count(F.lit(1)).alias("rows"))
    # rows to take out: all but the first, and repeats of the first
    out = save_shared(ranked.where("not keep or rows > 1"), "near-out")
    row = (F.col("doc_id"), F.col("text"))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                    row_key(*row).alias("rk"), second_key(*row).alias("rk2"))
    few = out.count() <= BROADCAST_ROWS
    gone = out.select(*key)
    kept = d.join(F.broadcast(gone) if few else gone, key, "left_anti")
    again = out.where("keep").select(*key)
    if not again.isEmpty():
        kept = kept.unionByName(d.join(again, key, "left_semi").dropDuplicates(key))
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
