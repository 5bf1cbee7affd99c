"""Quality and toxicity classifiers: features, held-out accuracy, odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import features, flat, quality_gam, toxicity

SF = "/root/testdata/sf0.01"


def test_flat_words_and_shingles_match_plain_python():
    rng = random.Random(1)
    texts = ["", "  ", "a", "a b", "A b a B", "é x\x0b y"] + [
        "".join(rng.choice("ab  \n\tcé") for _ in range(rng.randrange(200))) for _ in range(50)]
    f = flat.Flat([t.encode() for t in texts])
    want = [t.encode().lower().split() for t in texts]
    assert f.doc_words.tolist() == [len(w) for w in want]
    h, byword = f.word_hash(), {}
    for i, w in enumerate(x for ws in want for x in ws):
        assert byword.setdefault(w, h[i]) == h[i]
    assert len(set(byword.values())) == len(byword)
    for k in (1, 3, 5):
        d, s = f.shingles(k)
        grams, seen = [], {}
        for i, w in enumerate(want):
            n = len(w)
            grams += [(i, tuple(w))] if 0 < n < k else [(i, tuple(w[j:j + k])) for j in range(n - k + 1)]
        assert d.tolist() == [i for i, _ in grams]
        for (_, g), x in zip(grams, s):
            assert seen.setdefault(g, x) == x
        assert len(set(seen.values())) == len(seen)


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"One line.\nOne line.\nTwo!! WORDS #x", b"you idiot you", "é ü".encode(), b"a " * 50]
    together = features.quality_features(texts)
    alone = np.vstack([features.quality_features([t]) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()
    lex = toxicity.Lexicon(np.sort(flat.Flat([b"idiot moron"]).word_hash()), np.array([5.0, 5.0]))
    together = toxicity.toxic_features(texts + [b"an 1d.i0t"], lex)
    alone = np.vstack([toxicity.toxic_features([t], lex) for t in texts + [b"an 1d.i0t"]])
    assert np.allclose(together, alone) and np.isfinite(together).all()
    name = dict(zip(toxicity.FEATURES, together[2]))
    assert name["near_second"] > 0 and name["hit_rate"] == pytest.approx(1 / 3)
    assert dict(zip(toxicity.FEATURES, together[5]))["masked_hits"] > 0


def test_gam_learns_a_pairwise_pattern():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality_gam.fit_gam(x[:3000], y[:3000])
    assert ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.93
    assert quality_gam.fit_gam(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (quality_gam.fit_gam(x, np.ones(len(x))).score(x) > 0.9).all()


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    z = rng.normal(size=500)
    y = (rng.random(500) < toxicity.sigmoid(2 * z)).astype(float)
    k, p = toxicity.isotonic(z, y)
    assert (np.diff(k) > 0).all() and (np.diff(p) >= 0).all() and 0 <= p.min() and p.max() <= 1
    assert toxicity.isotonic(z[:0], y[:0])[1].tolist() == [0.5]


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_held_out_accuracy_and_odd_rows(spark, label):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = spark.createDataFrame([(None, "x"), (10 ** 9, None), (10 ** 9, ""), (7, "a " * 200_000)],
                                "doc_id long, text string")
    run = {"quality": quality_gam.quality_scores, "toxic": toxicity.toxicity_scores}[label]
    out = run(docs.unionByName(odd).withColumn("y", F.lit("clash")), labels).cache()
    assert out.count() == docs.count() + 4
    assert out.where("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    held = out.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held[label]).mean() >= 0.9
    assert run(docs.limit(0), labels).count() == 0


def test_without_labels_every_score_is_one_half(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for run in (quality_gam.quality_scores, toxicity.toxicity_scores):
        assert {round(r.score, 2) for r in run(docs, labels).collect()} == {0.5}


def test_drop_rejected_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality_gam.drop_rejected(docs.withColumn("score", F.lit("s")), labels)
    assert kept.columns == docs.columns + ["score"]
    bad = kept.join(labels.where("quality = 0"), "doc_id").count()
    assert bad <= 3 and kept.count() > 0.8 * docs.count()
