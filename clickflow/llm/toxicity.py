"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings far more frequent in toxic
documents of the labelled sample. The trees see its densities, how close hits
stand to second-person words, capitals, punctuation and how much of the
lexicon shows only after obfuscation is undone. For fitting, each half of the
sample is seen through the lexicon of the other half; three quarters of it
grow the trees and the rest calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.features import collect_sample, feature_rows, ratio, sample_ids
from clickflow.llm.flat import Flat, as_bytes, byte_table, chunks, mix
from clickflow.llm.quality_gam import sigmoid
from clickflow.llm.sqltext import held_out, save_shared

SAMPLE_ROWS = 20_000    # labelled documents used for learning, at most
LEXICON_SIZE = 4_096    # entries, at most
STEMS = (4, 5, 6, 8)    # word beginnings of so many bytes
MIN_DOCS = 5            # toxic documents an entry must be in
MIN_ODDS = 2.0          # log odds ratio of an entry
STRONG_ODDS = 4.0
NEAR = 4                # words between a hit and a second-person word
TREES = 120
DEPTH = 3
RATE = 0.12
RIDGE = 3.0
BINS = 48
THRESHOLD = 0.5

# Second-person words of the languages at hand.
SECOND_PERSON = ("you your yours yourself u ur ya du dich dir dein deine ihr euch euer sie tu te toi "
                 "ton ta tes vous votre vos usted ustedes ti tuyo tus su sus vosotros").split()

# Common look-alikes in obfuscated words, and marks put between letters.
LOOKALIKES = bytes.maketrans(b"0134578@$!|", b"oieastbasil")
MARKS = b"*_-.'~^"

FEATURES = ["hit_rate", "strong_rate", "log_hits", "log_strong", "odds_rate", "max_odds",
            "near_second", "second_rate", "masked_hits", "masked_rate", "mask_words", "leet_words",
            "long_runs", "caps_words", "upper", "shout", "point", "log_words"]

_KEEP = np.full(256, 32, dtype=np.uint8)       # punctuation becomes blank
for _c in [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]:
    _KEEP[_c] = _c
_KEEP_BYTES = _KEEP.tobytes()
_LETTER = byte_table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_UPPER, _LOWER = byte_table(bytes(range(65, 91))), byte_table(bytes(range(97, 123)))
_ODD = byte_table(b"0134578@$!|")
_MASK = byte_table(MARKS)
_SHOUT, _POINT = byte_table(b"!?"), byte_table(b".,;:!?")
_U = np.uint64


def _plain(texts: list[bytes]) -> Flat:
    return Flat([t.translate(_KEEP_BYTES) for t in texts])


def _unmasked(texts: list[bytes]) -> Flat:
    return Flat([t.translate(LOOKALIKES, MARKS).translate(_KEEP_BYTES) for t in texts])


def _keys(f: Flat) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word indices, hash) of whole words and of each stem length."""
    out = [(np.arange(len(f.start)), f.word_hash())]
    for n in STEMS:
        at = np.flatnonzero(f.end - f.start > n)
        h = f.hash_range(f.start[at], f.start[at] + n)
        out.append((at, mix(h + _U(n))))
    return out


_SECOND = np.sort(Flat([" ".join(SECOND_PERSON).encode()]).word_hash())


def _member(sorted_keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Position of each hash in ``sorted_keys``, -1 where it is not there."""
    if not len(sorted_keys):
        return np.full(len(h), -1)
    i = np.minimum(np.searchsorted(sorted_keys, h), len(sorted_keys) - 1)
    return np.where(sorted_keys[i] == h, i, -1)


@dataclass
class Lexicon:
    keys: np.ndarray   # sorted hashes
    odds: np.ndarray

    def word_odds(self, f: Flat) -> np.ndarray:
        """Largest log odds of any entry that each word has, 0 without one."""
        out = np.zeros(len(f.start))
        for at, h in _keys(f):
            i = _member(self.keys, h)
            found = i >= 0
            np.maximum.at(out, at[found], self.odds[i[found]])
        return out


def _max_per_doc(f: Flat, v: np.ndarray) -> np.ndarray:
    out = np.zeros(f.n)
    np.maximum.at(out, f.doc, v)
    return out


def toxic_features(texts: list[bytes], lexicon: Lexicon) -> np.ndarray:
    """One row per text, columns ``FEATURES``; without words all are 0."""
    raw, plain = Flat(texts, fold=False), _plain(texts)
    odds = lexicon.word_odds(plain)
    hit, strong = odds > 0, odds >= STRONG_ODDS
    words = plain.doc_words.astype(float)
    second = _member(_SECOND, plain.word_hash()) >= 0
    # hits with a second-person word at most NEAR words away in the same text
    c = np.concatenate(([0], np.cumsum(second)))
    i = np.arange(len(second))
    lo = np.maximum(i - NEAR, plain.first_word[plain.doc])
    hi = np.minimum(i + NEAR + 1, plain.first_word[plain.doc + 1])
    near = hit & (c[hi] - c[lo] > 0)

    un = _unmasked(texts)
    un_hits = un.per_word_sum(lexicon.word_odds(un) > 0)
    hits = plain.per_word_sum(hit)

    def counts(table: np.ndarray) -> np.ndarray:
        s = np.concatenate(([0], np.cumsum(table[raw.raw], dtype=np.int64)))
        return s[raw.end] - s[raw.start]

    letters, up, low = counts(_LETTER), counts(_UPPER), counts(_LOWER)
    masks, odd = counts(_MASK), counts(_ODD)
    chars = raw.per_word_sum((raw.end - raw.start).astype(float))
    run = np.zeros(len(raw.raw), dtype=bool)   # third of three equal letters
    if len(run) > 2:
        run[2:] = (raw.raw[2:] == raw.raw[1:-1]) & (raw.raw[2:] == raw.raw[:-2]) & _LETTER[raw.raw[2:]]
    raw_words = raw.doc_words.astype(float)
    cols = [
        ratio(hits, words), ratio(plain.per_word_sum(strong), words), np.log1p(hits),
        np.log1p(plain.per_word_sum(strong)), ratio(plain.per_word_sum(odds), words),
        _max_per_doc(plain, odds), np.log1p(plain.per_word_sum(near)),
        ratio(plain.per_word_sum(second), words), np.log1p(np.maximum(un_hits - hits, 0)),
        ratio(np.maximum(un_hits - hits, 0), words),
        ratio(raw.per_word_sum((masks > 0) & (letters > 1)), raw_words),
        ratio(raw.per_word_sum((odd > 0) & (letters > 1)), raw_words),
        ratio(raw.per_doc(run), raw_words), ratio(raw.per_word_sum((up >= 2) & (low == 0)), raw_words),
        ratio(raw.per_word_sum(up), chars), ratio(raw.per_word_sum(counts(_SHOUT)), chars),
        ratio(raw.per_word_sum(counts(_POINT)), chars), np.log1p(raw_words)]
    return np.column_stack(cols).astype(float)


def fit_lexicon(rows: DataFrame) -> Lexicon:
    """Lexicon from ``rows`` (text, y). Keys are counted once per document, within
    each batch first, then summed by Spark; only the best ``LEXICON_SIZE``
    entries come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(b.schema.get_field_index("text")))
            y = b.column(b.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(texts):
                f = _plain(texts[lo:hi])
                d, h = zip(*[(f.doc[at], h) for at, h in _keys(f)])
                d, h = np.concatenate(d), np.concatenate(h)
                o = np.lexsort((d, h))
                d, h = d[o], h[o]
                once = np.ones(len(d), dtype=bool)
                once[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
                keys, group = np.unique(h[once], return_inverse=True)
                t = np.bincount(group, weights=y[lo:hi][d[once]], minlength=len(keys))
                n = np.bincount(group, minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(t.astype(np.int64)),
                     pa.array(n.astype(np.int64))], ["k", "t", "n"])

    total = rows.agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    toxic, clean = float(total["t"]), float(total["n"] - total["t"])
    sums = (rows.select("text", "y").mapInArrow(count, "k long, t long, n long").groupBy("k")
            .agg(F.sum("t").alias("t"), F.sum("n").alias("n")).where(F.col("t") >= MIN_DOCS))
    odds = (F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5))
            - F.log((F.col("n") - F.col("t") + 0.5) / (clean - F.col("n") + F.col("t") + 0.5)))
    best = (sums.withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS)
            .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "k").limit(LEXICON_SIZE).collect())
    keys = np.array([r["k"] for r in best], dtype=np.int64).view(np.uint64)
    o = np.argsort(keys)
    return Lexicon(keys[o], np.array([r["odds"] for r in best], dtype=float)[o])


@dataclass
class Forest:
    """Trees as arrays over complete binary nodes: feature, cut and leaf value."""
    base: float
    feature: np.ndarray   # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray      # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            z += v[node - (2 ** DEPTH - 1)]
        return z


def fit_forest(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the logistic loss, split on quantile bins."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    p = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    if not len(y):
        return Forest(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    width = BINS + 1
    z = np.full(len(y), base)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        q = sigmoid(z)
        g, h = y - q, q * (1 - q)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.full(count, 1e-6)
            for j in range(x.shape[1]):
                if not len(cuts[j]):
                    continue
                at = local * width + binned[:, j]
                gl = np.bincount(at, g, count * width).reshape(count, width).cumsum(1)
                hl = np.bincount(at, h, count * width).reshape(count, width).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = (gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE)
                        - gt ** 2 / (ht + RIDGE))[:, :len(cuts[j])]
                k = gain.argmax(1)
                better = gain[np.arange(count), k] > best
                best = np.where(better, gain[np.arange(count), k], best)
                feature[first:first + count][better] = j
                cut[first:first + count][better] = cuts[j][k[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - inner
        leaf = RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        z += leaf[at]
        features.append(feature)
        thresholds.append(cut)
        values.append(leaf)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, probability) of the non-decreasing fit of y to z; pooled
    blocks are smoothed by one success and one failure in ten."""
    o = np.argsort(z, kind="stable")
    zs, ys = z[o], y[o]
    blocks: list[list[float]] = []   # sum z, sum y, n
    for a, b in zip(zs, ys):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]):
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    b = np.array(blocks)
    p = (b[:, 1] + 0.1) / (b[:, 2] + 0.2)
    return b[:, 0] / b[:, 2], np.maximum.accumulate(p)


@dataclass
class ToxicModel:
    lexicon: Lexicon
    forest: Forest
    knots: tuple[np.ndarray, np.ndarray]

    def score_texts(self, texts: list[bytes]) -> np.ndarray:
        """Calibrated probability of label 1. A small share of the uncalibrated
        one keeps the order of documents inside a flat step."""
        z = self.forest.raw(toxic_features(texts, self.lexicon))
        return np.clip(0.999 * np.interp(z, *self.knots) + 0.001 * sigmoid(z), 0, 1)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Model from ``labels`` (doc_id, toxic) of documents outside the held-out
    fold; the sample's ids, at most ``max_rows``, are broadcast. Without
    labels every score is 1/2."""
    ids = sample_ids(labels, "toxic", max_rows)
    # read six times below: at most ``max_rows`` documents (and repeats of them)
    picked = save_shared(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"),
                         "toxicity-sample", few_files=True)
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2))
    xs, ys = [], []
    for h in (0, 1):
        lexicon = fit_lexicon(picked.where(half != h))
        rows = feature_rows(picked.where(half == h), _Extract(lexicon), ["doc_id", "y"])
        x, y = collect_sample(rows, max_rows, len(FEATURES))
        xs.append(x)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    lexicon = fit_lexicon(picked)
    calibrate = np.arange(len(y)) % 4 == 3   # rows are in hash order
    forest = fit_forest(x[~calibrate], y[~calibrate])
    return ToxicModel(lexicon, forest, isotonic(forest.raw(x[calibrate]), y[calibrate]))


@dataclass
class _Extract:
    lexicon: Lexicon

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        return toxic_features(texts, self.lexicon)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted per row of ``docs``: every whole
    text, also empty and NULL ones; repeated rows give one each."""
    model = fit_toxicity(docs, labels)
    rows = feature_rows(docs, lambda texts: model.score_texts(texts)[:, None], ["doc_id"])
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.col("x")[0].alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
