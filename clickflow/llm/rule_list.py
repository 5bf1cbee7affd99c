"""Quality rules: text statistics and a learned decision list over them.

Statistics are Spark expressions on the whole text. From a bounded sample of
labelled rows, sequential covering grows conjunctions of thresholds for the
bad class on two thirds of the sample, prunes each on the other third, and
stops when a rule is no longer precise enough. The list is emitted as one
ordered ``CASE WHEN`` expression, so applying it is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.sqltext import chars_of, crc_fold, let, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SAMPLE_ROWS = 20_000    # labelled rows the list is learned from, at most
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.8     # of a pruned rule, on the pruning third
MIN_COVER = 5           # sample rows a rule must cover
CUTS = 32               # candidate thresholds per statistic

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
            "punct_rate", "digit_rate", "type_rate"]


def repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Each window is one long: the high bits of its hash over the window's
    position, with as many position bits as the text needs. Sorting the longs
    puts equal windows side by side; neighbours are compared on the hash bits
    and then on the words themselves. The covered words follow from the
    sorted positions: each adds the part of its three words that the next one
    does not start in. Work is n log n for any text.
    """
    def counted(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w)))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def with_bits(b: Column) -> Column:
            bits, low = b["bits"], b["low"]
            packed = F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: (F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(F.bitwise_not(low)))
                .bitwiseOR(i.cast("long")))

            def same(x: Column, y: Column) -> Column:
                i, j = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
                return ((F.call_function("shiftright", x.bitwiseXOR(y), bits) == 0) & (w[i] == w[j])
                        & (w[i + 1] == w[j + 1]) & (w[i + 2] == w[j + 2]))

            def repeated(s: Column) -> Column:
                return F.filter(s, lambda x, i: (
                    F.coalesce(same(x, F.get(s, i - 1)), F.lit(False))
                    | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))))

            at = F.sort_array(F.transform(let(F.sort_array(packed), repeated),
                                          lambda x: x.bitwiseAND(low)))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)),
                                                    F.lit(3).cast("long"))),
                F.lit(0).cast("long"), lambda a, x: a + x))

        return F.when(F.size(w) >= 4, let(F.struct(bits.alias("bits"), low.alias("low")),
                                          with_bits)).otherwise(F.lit(0).cast("long"))

    return let(w, counted)


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the learned list's features, per row.

    NULL and empty texts have all counts 0. The words are extracted once per
    row and bound for everything that needs them.
    """
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("_w", let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeat_words(w).alias("rep"),
        F.size(F.array_distinct(w)).cast("long").alias("types"))))
    text = F.col("text")
    t = t.select(
        "doc_id", "_w",
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        chars_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        dup_lines(text).cast("long").alias("n_dup_lines"),
        F.regexp_count(text, F.lit(r"\n")).cast("long").alias("_lines"),
        chars_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"),
        chars_of(text, "!?.,;:").alias("_punct"), chars_of(text, "0123456789").alias("_digit"))
    n = F.greatest(F.col("_w")["n"], F.lit(1)).cast("double")
    c = F.greatest("word_chars", F.lit(1)).cast("double")
    return t.select(
        "doc_id", F.col("_w")["n"].alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_w")["rep"].alias("n_repeat_words"),
        (F.col("word_chars") / n).alias("mean_word"),
        (F.col("n_symbols") / c).alias("symbol_rate"),
        (F.col("n_dup_lines") / (F.col("_lines") + 1)).alias("dup_line_rate"),
        (F.col("_w")["rep"] / n).alias("repeat_rate"), (F.col("_upper") / c).alias("upper_rate"),
        (F.col("_punct") / c).alias("punct_rate"), (F.col("_digit") / c).alias("digit_rate"),
        (F.col("_w")["types"] / n).alias("type_rate"))


@dataclass(frozen=True)
class Rule:
    """``conditions`` (feature, '<=' or '>', threshold) all hold: bad."""
    conditions: tuple[tuple[str, str, float], ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        hit = np.ones(len(x), dtype=bool)
        for f, op, cut in self.conditions:
            v = x[:, FEATURES.index(f)]
            hit &= (v <= cut) if op == "<=" else (v > cut)
        return hit

    def column(self) -> Column:
        out = F.lit(True)
        for f, op, cut in self.conditions:
            out = out & ((F.col(f) <= cut) if op == "<=" else (F.col(f) > cut))
        return out


def _grow(x: np.ndarray, bad: np.ndarray) -> tuple[tuple[str, str, float], ...]:
    """Add the threshold with the best information gain for the bad class
    until the rule covers bad rows only."""
    live, conds = np.ones(len(x), dtype=bool), []
    while len(conds) < MAX_CONDITIONS:
        p0, n0 = bad[live].sum(), live.sum()
        if p0 == 0 or p0 == n0:
            break
        base, best = np.log2(p0 / n0), (0.0, None, None)
        for j, f in enumerate(FEATURES):
            v = x[live, j]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:-1], method="lower")):
                for op, hit in (("<=", v <= cut), (">", v > cut)):
                    n = hit.sum()
                    p = bad[live][hit].sum()
                    if n < MIN_COVER or p == 0 or n == n0:
                        continue
                    gain = p * (np.log2(p / n) - base)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, op, float(cut)), (j, op, cut))
        if best[1] is None:
            break
        conds.append(best[1])
        j, op, cut = best[2]
        live &= (x[:, j] <= cut) if op == "<=" else (x[:, j] > cut)
    return tuple(conds)


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    hit = rule.covers(x)
    n, p = hit.sum(), bad[hit].sum()
    return (2.0 * p - n) / max(n, 1)


def learn_rules(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Sequential covering over feature rows ``x`` (columns ``FEATURES``).

    Rows are taken in the given order; every third one prunes. No rows, or
    rows of one class, give an empty list.
    """
    rules: list[Rule] = []
    live = np.ones(len(x), dtype=bool)
    third = np.arange(len(x)) % 3 == 2
    while len(rules) < MAX_RULES and bad[live].any() and not bad[live].all():
        g, q = live & ~third, live & third
        conds = _grow(x[g], bad[g])
        if not conds:
            break
        # prune: the shortest prefix that is best on the other third
        rule = max((Rule(conds[:i]) for i in range(1, len(conds) + 1)),
                   key=lambda r: (round(_worth(r, x[q], bad[q]), 6), -len(r.conditions)))
        hit = rule.covers(x) & q
        if hit.sum() == 0 or bad[hit].mean() < MIN_PRECISION:
            break
        if (rule.covers(x) & live).sum() < MIN_COVER:
            break
        rules.append(rule)
        live &= ~rule.covers(x)
    return rules


def sample_stats(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and label of at most ``max_rows`` labelled rows outside the
    held-out fold, taken in the order of a hash of the id. The sample's ids
    are bounded by ``max_rows`` and so may be broadcast."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()
                        & (crc_fold(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    bad = picked.select("doc_id", "text", "bad")
    return text_stats(bad).join(F.broadcast(ids), "doc_id")


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> list[Rule]:
    rows = (sample_stats(docs, labels, max_rows).select("doc_id", "bad", *FEATURES)
            .orderBy(F.xxhash64("doc_id"), *FEATURES).limit(max_rows).collect())
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows]).reshape(len(rows), len(FEATURES))
    return learn_rules(x, np.array([r["bad"] for r in rows], dtype=bool))


def verdict(rules: list[Rule]) -> Column:
    """Index (1-based) of the first rule that fires, 0 for none."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule.column(), i) if out is None else out.when(rule.column(), i)
    return F.lit(0) if out is None else out.otherwise(0)


def apply_rules(docs: DataFrame, rules: list[Rule], min_words: int = 50,
                max_repeat_pct: int = 50) -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts, base_failed, the first
    learned rule that fires (0: none) and kept.

    A text without words fails the base (n_words < min_words). Repeated rows
    and NULL ids give one row each.
    """
    s = text_stats(docs).withColumn("rule", verdict(rules))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
    return s.select("doc_id", *BASE, failed.alias("base_failed"), "rule",
                    (~failed & (F.col("rule") == 0)).alias("kept"))
