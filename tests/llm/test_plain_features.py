"""The classifiers' features and scores, written out in plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickflow.llm import features, quality_gam, toxicity

UP, LOW = set(range(65, 91)), set(range(97, 123))


def texts():
    r = random.Random(21)
    parts = ["You", "are", "AN", "idi0t", "st*pid", "the", "the", "good", "día", "x", "#$%", "Stop!!",
             "foooo", "ISBN-13:", "a.b", "du", "\n", "\n", "\t", "  ", "A\x1cB", "e.g.,", "\"Ok.\""]
    out = ["".join(r.choice(parts) + r.choice([" ", "\n", ""]) for _ in range(r.randrange(60))) for _ in range(150)]
    return [t.encode() for t in [*out, "", " \n", "one", "One\none \n ONE"]]


def rate(a, b):
    return a / max(b, 1)


def plain_quality(t: bytes) -> list[float]:
    words = t.split()
    folded = [w.lower() for w in words]
    n, chars = len(words), sum(map(len, words))

    def of(chars_in):
        return sum(c in chars_in for w in words for c in w)

    mean = rate(chars, n)
    spread = math.sqrt(max(rate(sum(len(w) ** 2 for w in words), n) - mean ** 2, 0))
    upper = [sum(c in UP for c in w) for w in words]
    lower = [sum(c in LOW for c in w) for w in words]
    symbol = set(b"#*$%&|<>{}[]\\^~=+_@/")
    grams = [tuple(folded)] if 0 < n < 3 else [tuple(folded[i:i + 3]) for i in range(n - 2)]
    lines = [x.strip(b" \t\r\x0b\x0c").lower() for x in t.split(b"\n")]
    lines = [x for x in lines if x]
    return [math.log1p(n), mean, spread, rate(sum(upper), chars), rate(of(set(b"0123456789")), chars),
            rate(of(symbol), chars), rate(of(set(b".,;:!?")), chars), rate(of(set(b"!?")), chars),
            rate(of(set(range(128, 256))), chars),
            rate(sum(u >= 2 and not x for u, x in zip(upper, lower)), n),
            rate(sum(any(c in symbol for c in w) for w in words), n),
            rate(sum(len(w) <= 2 for w in words), n), rate(len(set(folded)), n),
            rate(len(grams) - len(set(grams)), len(grams)),
            rate(sum(a == b for a, b in zip(folded, folded[1:])), n),
            rate(max(Counter(folded).values(), default=0), n), rate(len(lines) - len(set(lines)), len(lines)),
            rate(len(lines), n), rate(sum(x[-1] in b".!?\"')" for x in lines), len(lines))]


def test_quality_features():
    got = features.quality_features(texts())
    want = np.array([plain_quality(t) for t in texts()])
    for j, name in enumerate(features.QUALITY):
        assert got[:, j] == pytest.approx(want[:, j], abs=1e-9), name


KEPT = {*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)}
LETTERS = {*range(65, 91), *range(97, 123), *range(128, 256)}


def plain_words(t: bytes) -> list[bytes]:
    return [w.lower() for w in bytes(c if c in KEPT else 32 for c in t).split()]


def plain_toxic(t: bytes, odds) -> list[float]:
    w, raw = plain_words(t), t.split()
    o = [odds(x) for x in w]
    second = [x.decode("utf-8", "replace") in toxicity.SECOND_PERSON for x in w]
    n, m = len(w), len(raw)
    hits, strong = sum(x > 0 for x in o), sum(x >= toxicity.STRONG_ODDS for x in o)
    near = sum(x > 0 and any(second[max(i - 4, 0):i + 5]) for i, x in enumerate(o))
    undone = t.translate(toxicity.LOOKALIKES, toxicity.MARKS)
    more = max(sum(odds(x) > 0 for x in plain_words(undone)) - hits, 0)

    def marked(marks):
        return sum(any(c in marks for c in x) and sum(c in LETTERS for c in x) > 1 for x in raw)

    runs = sum(1 for x in raw for i in range(2, len(x)) if x[i] == x[i - 1] == x[i - 2] and x[i] in LETTERS)
    chars = sum(map(len, raw))
    caps = sum(sum(c in UP for c in x) >= 2 and not any(c in LOW for c in x) for x in raw)

    def of(table):
        return sum(c in table for x in raw for c in x)

    return [rate(hits, n), rate(strong, n), math.log1p(hits), math.log1p(strong), rate(sum(o), n),
            max([0, *o]), math.log1p(near), rate(sum(second), n), math.log1p(more), rate(more, n),
            rate(marked(toxicity.MARKS), m), rate(marked(b"0134578@$!|"), m), rate(runs, m), rate(caps, m),
            rate(of(UP), chars), rate(of(b"!?"), chars), rate(of(b".,;:!?"), chars), math.log1p(m)]


@pytest.fixture(scope="module")
def lexicon(spark):
    """A learned lexicon and its plain counterpart, of the same texts."""
    r = random.Random(2)
    rows = [(" ".join(r.choice(["idiot", "stupid", "you", "are"] if y else ["good", "day", "the", "are"])
                      for _ in range(6)), y) for y in [0, 1] * 40]
    learned = toxicity.fit_lexicon(spark.createDataFrame(rows, "text string, y int"))
    toxic, clean = 40.0, 40.0
    t, n = defaultdict(int), defaultdict(int)
    for text, y in rows:
        keys = set()
        for w in plain_words(text.encode()):
            keys |= {w} | {(w[:k], k) for k in toxicity.STEMS if len(w) > k}
        for k in keys:
            t[k] += y
            n[k] += 1
    odds = {}
    for k in t:
        v = (math.log((t[k] + .5) / (toxic - t[k] + .5))
             - math.log((n[k] - t[k] + .5) / (clean - n[k] + t[k] + .5)))
        if t[k] >= toxicity.MIN_DOCS and v >= toxicity.MIN_ODDS:
            odds[k] = v

    def of(w: bytes) -> float:
        return max([odds.get(w, 0), *(odds.get((w[:k], k), 0) for k in toxicity.STEMS if len(w) > k)])

    return learned, of, len(odds)


def test_toxic_lexicon_and_features(lexicon):
    learned, odds, size = lexicon
    assert len(learned.keys) == size > 3
    got = toxicity.toxic_features(texts(), learned)
    want = np.array([plain_toxic(t, odds) for t in texts()])
    for j, name in enumerate(toxicity.FEATURES):
        assert got[:, j] == pytest.approx(want[:, j], abs=1e-9), name


def test_toxic_score_walks_the_trees(lexicon):
    learned, odds, _ = lexicon
    r = np.random.default_rng(0)
    x = toxicity.toxic_features(texts(), learned)
    y = (x[:, 0] + r.normal(size=len(x)) * 0.1 > x[:, 0].mean()).astype(float)
    forest = toxicity.fit_forest(x, y)
    model = toxicity.ToxicModel(learned, forest, toxicity.isotonic(forest.raw(x), y))
    got = model.score_texts(texts())
    zs, ps = model.knots
    for t, p in zip(texts(), got):
        f, z = plain_toxic(t, odds), forest.base
        for k in range(len(forest.feature)):
            node = 0
            while node < len(forest.feature[k]):
                node = 2 * node + 1 + (f[forest.feature[k][node]] > forest.cut[k][node] + 1e-12)
            z += forest.leaf[k][node - len(forest.feature[k])]
        if z <= zs[0] or len(zs) == 1:
            q = ps[0]
        elif z >= zs[-1]:
            q = ps[-1]
        else:
            i = max(j for j in range(len(zs)) if zs[j] <= z)
            q = ps[i] + (ps[i + 1] - ps[i]) * (z - zs[i]) / (zs[i + 1] - zs[i])
        assert p == pytest.approx(0.999 * q + 0.001 / (1 + math.exp(-z)), abs=1e-6)


def test_isotonic_is_the_least_squares_fit():
    r = random.Random(3)
    z = np.array(sorted(r.random() for _ in range(60)))
    y = np.array([float(r.random() < v) for v in z])
    zs, ps = toxicity.isotonic(z, y)
    # the fit by its max-min formula, smoothed per block
    fit = [max(min(y[a:b + 1].mean() for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
    blocks = defaultdict(list)
    for i, v in enumerate(fit):
        blocks[round(v, 12)].append(i)
    want = [(y[b].sum() + .1) / (len(b) + .2) for _, b in sorted(blocks.items())]
    assert ps == pytest.approx(np.maximum.accumulate(want))
    assert zs == pytest.approx([z[b].mean() for _, b in sorted(blocks.items())])


def test_quality_query_adds_up_its_tables(spark):
    """op1's rows from the fitted tables, document by document."""
    from clickflow.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = quality_gam.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r for r in queries.op1_gam_quality(spark, sf).collect()}

    def at(cuts, v):
        return sum(c < v - 1e-12 for c in cuts)

    for d in docs.collect():
        f = plain_quality((d.text or "").encode())
        z = model.intercept + sum(t[at(c, v)] for (c, t), v in zip(model.mains, f))
        z += sum(t[at(ci, f[i]), at(cj, f[j])] for i, j, ci, cj, t in model.pairs)
        score = 1 / (1 + math.exp(-z))
        assert got[d.doc_id].score == pytest.approx(score, abs=1e-9)
        assert got[d.doc_id].predicted == int(got[d.doc_id].score >= 0.3)
