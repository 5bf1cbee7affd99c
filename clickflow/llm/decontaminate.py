"""Benchmark decontamination by a broadcast hash set of test n-grams.

Each benchmark item gives its windows of ``N`` words (an item of fewer words
is one window). Training texts are cut into the same windows, their hashes
are looked up in the broadcast set, and a hit is verified word by word. A text
is first cut into segments of ``SEGMENT`` window starts, and a window's row
carries its segment's words alone, so the work is in proportion to a text's
length, however long it is. Windows are exploded, probed and dropped within one
stage; what is shuffled is the verified hits and one short row per document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.sqltext import ascii_lower, let, save_shared, split_words, words

# ASCII letters and digits, and everything beyond ASCII, make words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words in a text that is not lower-cased.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
N = 10
SEGMENT = 128   # window starts in a segment of a text

# Windows in one broadcast set. A larger benchmark is probed in several
# rounds over the documents, each with a part of the set of this size.
MAX_SET_ROWS = 1_000_000


def item_words(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _window_hash(hashes: Column, i: Column, n: int) -> Column:
    """Hash of the window of ``n`` words from position ``i`` (0-based)."""
    return F.xxhash64(F.lit(n), *[hashes[i + j] for j in range(n)])


def window_set(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window of ``benchmark`` (item_id, text): size, h
    (hash), window (words joined by blanks) and items (ids as strings, sorted;
    a NULL id reads ``null``). Texts without words give none."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                         item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    b = b.withColumn("size", F.least(F.size("w"), F.lit(n)))
    starts = F.explode(F.sequence(F.lit(0), F.size("w") - F.col("size")))
    b = b.select("item", "w", word_hashes(F.col("w")).alias("wh"), "size", starts.alias("i"))
    h = F.coalesce(*[F.when(F.col("size") == k, _window_hash(F.col("wh"), F.col("i"), k))
                     for k in range(n, 0, -1)])
    window = F.array_join(F.slice("w", F.col("i") + 1, F.col("size")), " ")
    return (b.select("size", h.alias("h"), window.alias("window"), "item")
            .groupBy("size", "h", "window")
            .agg(F.sort_array(F.collect_set("item")).alias("items")))


def _segments(w: Column, longest: int) -> Column:
    """(base, n, part) of a text's segments: the position of the first word, the
    text's number of words, and the words of all windows that start in it. A
    text without words has one empty segment."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(SEGMENT))
    return F.transform(starts, lambda s: F.struct(
        s.alias("base"), F.size(w).alias("n"),
        F.slice(w, s + 1, SEGMENT + longest - 1).alias("part")))


def _layout(sizes: list[int]) -> tuple[Column, Column, Column]:
    """The hash array of a segment's windows, one size after another behind a
    leading NULL, and the (size, start in the segment) of array position ``p``."""
    def starts(words: Column, k: int) -> Column:
        return F.least(F.lit(SEGMENT), F.greatest(F.size(words) - k + 1, F.lit(0)))

    def windows(h: Column, k: int) -> Column:
        return F.when(starts(h, k) > 0, F.transform(
            F.sequence(F.lit(0), starts(h, k) - 1), lambda i: _window_hash(h, i, k))
        ).otherwise(F.array().cast("array<long>"))

    def laid_out(h: Column) -> Column:
        return F.concat(F.array(F.lit(None).cast("long")), *[windows(h, k) for k in sizes])

    at, size, start = F.lit(1), None, None
    for k in sizes:
        inside = F.col("p") < at + starts(F.col("part"), k)
        here = F.col("p") - at
        size = F.when(inside, k) if size is None else size.when(inside, k)
        start = F.when(inside, here) if start is None else start.when(inside, here)
        at = at + starts(F.col("part"), k)
    return let(word_hashes(F.col("part")), laid_out), size, start


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, row): each row as a struct and its number. The same rows get the
    same numbers whenever a scan or written table is read."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.monotonically_increasing_id().alias("row"))


def _probe(docs: DataFrame, benchmark: DataFrame, n: int, max_set_rows: int,
           keep: list[str] | None) -> DataFrame:
    """row, head, hit, items: one row per verified hit (start, size), and with
    ``keep`` one per document whose ``head`` has these columns and n_words."""
    grams = save_shared(window_set(benchmark, n), "benchmark-windows")
    by_size = {r["size"]: r["count"] for r in grams.groupBy("size").count().collect()}  # <= n rows
    sizes = sorted(by_size, reverse=True) or [n]
    rounds = max(1, -(-sum(by_size.values()) // max_set_rows))

    hashes, size, start = _layout(sizes)
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")] if keep else []
    names = ["doc"] * bool(keep) + ["row"]
    d = docs.select(*kept, "text", F.monotonically_increasing_id().alias("row"))
    d = d.select(*names, F.explode(let(
        item_words(F.col("text")), lambda w: _segments(w, sizes[0]))).alias("s"))
    d = d.select(*names, "s.base", "s.n", "s.part")
    d = d.select(*names, "base", "n", "part", F.posexplode(hashes).alias("p", "dh"))
    # the leading NULL is at no window; its values here only have to be legal
    size = F.coalesce(size, F.lit(0))
    start = F.greatest(F.coalesce(start, F.lit(0)), F.lit(0))

    def probe(part: int) -> DataFrame:
        g = grams if rounds == 1 else grams.where(F.pmod("h", F.lit(rounds)) == part)
        g = g.select("h", "window", "items")
        # one long to probe by; the words are compared on a hit only
        same = ((F.col("dh") == F.col("h"))
                & (F.array_join(F.slice("part", start + 1, size), " ") == F.col("window")))
        heads = bool(keep) and part == 0
        j = d.join(F.broadcast(g), same, "left" if heads else "inner")
        found = F.col("items").isNotNull()
        first = (F.col("p") == 0) & (F.col("base") == 0)
        head = (F.when(first, F.struct("doc", F.col("n").cast("long").alias("n_words")))
                if keep else F.lit(None).cast("struct<n_words: long>"))
        return j.where((found | first) if heads else found).select(
            "row", head.alias("head"),
            F.when(found, F.struct((F.col("base") + start).alias("start"), size.alias("size"))).alias("hit"),
            "items")

    return reduce(DataFrame.unionByName, [probe(i) for i in range(rounds)])


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = N,
              max_set_rows: int = MAX_SET_ROWS, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (a scan or written table, so that it has the same
    order whenever it is read): doc (a struct of its columns ``keep``, small ones,
    by default doc_id), n_words, hits (sorted (start, size) word windows) and
    items (sorted ids as strings).

    Every document row counts on its own, also repeated ones. NULL text has no
    words. An empty benchmark gives no hits.
    """
    g = _probe(docs, benchmark, n, max_set_rows, keep or ["doc_id"]).groupBy("row").agg(
        F.first("head", ignorenulls=True).alias("head"),
        F.sort_array(F.collect_list("hit")).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return g.select(F.col("head")["doc"].alias("doc"), F.col("head")["n_words"].alias("n_words"),
                    "hits", "items")


def merged_spans(hits: DataFrame) -> DataFrame:
    """row, spans: the windows (row, hit) of each row as disjoint (start, end)
    word ranges in order, by a running maximum of the ends."""
    h = hits.select("row", F.col("hit.start").alias("start"),
                    (F.col("hit.start") + F.col("hit.size")).alias("end"))
    w = Window.partitionBy("row").orderBy("start", "end")
    seen = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = h.withColumn("new", F.coalesce(F.col("start") > seen, F.lit(True)).cast("int"))
    h = h.withColumn("nth", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = h.groupBy("row", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return one.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def hit_words(hits: Column) -> Column:
    """Number of words inside any of the sorted (start, size) windows."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, h: Column) -> Column:
        end = F.greatest(a["end"], h["start"] + h["size"])
        return F.struct(end.alias("end"), (
            a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], h["start"]))).alias("n"))

    return F.aggregate(hits, zero, add, lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids and contaminated per row."""
    f = find_hits(docs, benchmark, n, keep=["doc_id"])
    return f.select(F.col("doc")["doc_id"].alias("doc_id"), "n_words",
                    hit_words(F.col("hits")).alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), F.col("items").alias("item_ids"),
                    (F.size("hits") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``docs`` (a scan or written table) without the rows that hold a benchmark
    window; same columns. The numbers of those rows are written first, so that
    the join goes by their size and moves no text while they are few."""
    hit = save_shared(_probe(docs, benchmark, n, MAX_SET_ROWS, None).select("row").distinct(),
                      "contaminated-rows", few_files=True)
    return _numbered(docs).join(hit, "row", "left_anti").select("doc.*") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``docs`` (a scan or written table) with every word inside a benchmark
    window taken out of ``text``; other characters stay. Same columns and rows."""
    hits = _probe(docs, benchmark, n, MAX_SET_ROWS, None)
    spans = save_shared(merged_spans(hits), "contaminated-spans", few_files=True)
    f = _numbered(docs).join(spans, "row", "left").withColumn("text", F.col("doc")["text"])

    def cut(t: Column) -> Column:
        # a piece is what stands before a word, and the word unless it is in a span
        gaps, w = t["gaps"], t["words"]
        last = F.struct(F.size(w).alias("start"), F.size(w).alias("end"))
        ranges = F.concat("spans", F.array(last))
        pieces = F.transform(ranges, lambda r, i: F.concat(
            let(F.when(i == 0, 0).otherwise(F.get(ranges, i - 1)["end"]), lambda lo: F.zip_with(
                F.slice(gaps, lo + 1, r["start"] - lo), F.slice(w, lo + 1, r["start"] - lo),
                lambda g, x: F.concat(g, x))),
            F.slice(gaps, r["start"] + 1, r["end"] - r["start"])))
        return F.concat(F.array_join(F.flatten(pieces), ""), F.element_at(gaps, -1))

    taken = let(F.struct(F.split("text", ANY_CASE, -1).alias("gaps"),
                         words(F.col("text"), ANY_CASE).alias("words")), cut)
    text = F.when(F.col("spans").isNotNull(), taken).otherwise(F.col("text"))
    return f.select(*[text.alias(c) if c == "text" else F.col("doc")[c].alias(c)
                      for c in docs.columns])
