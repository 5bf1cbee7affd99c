"""Decontamination against brute force, with a set probed in one or many rounds."""

import re

import pytest

from clickflow.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEM = "The quick Brown fox, jumps over 13 lazy dogs; near the étang today."
ITEMS = [(1, ITEM), (2, "alpha beta"), (10, "alpha  BETA!"), (3, None), (4, "..."), (None, ITEM),
         (5, "one two three four five six seven eight nine ten"), (5, "gamma"),
         (7, "r r r r r r r r r r r r")]
DOCS = [(0, None), (1, ""), (2, "no hit here at all"), (3, "x " + ITEM.upper().replace("É", "é") + " y"),
        (4, "ALPHA, beta alpha beta"), (5, "the quick brown fox jumps over 13 lazy dogs"),
        (6, "the quick brown fox jumps over 13 lazy dogs near"), (7, "gamma " * 50 + "alphabeta"),
        (8, "r " * 40), (9, ("filler words go on " * 5000) + " one two three four five six seven "
                            "eight nine ten"), (9, "gamma"), (None, "gamma")]


def words(t):
    return [x for x in WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))]


def brute(docs, items, n=10):
    grams = {}
    for item, t in items:
        w = words(t)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + k]), set()).add("null" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                g = tuple(w[i:i + k])
                if g in grams:
                    hit.update(range(i, i + k))
                    ids |= grams[g]
        out.append((d, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("set_rows", [1_000_000, 3])
def test_contamination_matches_brute_force(spark, set_rows):
    docs = spark.createDataFrame([(d, t, "w") for d, t in DOCS], "doc_id long, text string, w string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    f = dc.find_hits(docs, items, max_set_rows=set_rows)
    got = sorted(((r.doc.doc_id, r.n_words, sum_hit(r.hits), r["items"], bool(r.hits))
                  for r in f.collect()), key=repr)
    assert got == brute(DOCS, ITEMS)
    if set_rows > 3:
        c = dc.contamination(docs, items).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in c),
                      key=repr) == brute(DOCS, ITEMS)


def sum_hit(hits):
    return len({j for h in hits for j in range(h.start, h.start + h["size"])})


def test_dropping_and_removing(spark):
    docs = spark.createDataFrame([(d, t, "en") for d, t in DOCS], "doc_id long, text string, lang string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 5]
    cut = {(r.doc_id, r.text) for r in dc.remove_spans(docs, items).collect()}
    assert (4, ",   ") in cut and (0, None) in cut and (2, "no hit here at all") in cut
    assert dict(cut)[3] == "x      ,     ;   é ." + " y" or not brute([(3, dict(cut)[3])], ITEMS)[0][4]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.contamination(docs.limit(0), items).count() == 0
    none = dc.contamination(docs, items.limit(0))
    assert none.count() == len(DOCS) and none.where("contaminated").count() == 0


def test_removing_keeps_every_other_character(spark):
    import random
    r = random.Random(8)
    items = [(i, " ".join(r.choice("abcde") for _ in range(r.randrange(1, 14)))) for i in range(6)]
    docs = []
    for i in range(60):
        w = [r.choice("abcdefgh") for _ in range(r.randrange(0, 400))]
        t = "".join(r.choice([" ", ", ", "\n"]) + x for x in w) + r.choice(["", "."])
        docs.append((i, t.lstrip() if i % 2 else t))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, row int")
    got = {x.doc_id: x.text for x in dc.remove_spans(df, spark.createDataFrame(
        items, "item_id long, text string")).collect()}
    grams = [words(t)[i:i + min(10, len(words(t)))] for _, t in items
             for i in range(len(words(t)) - min(10, len(words(t))) + 1)]
    for d, t in docs:
        w = list(WORD.finditer(t))
        hit = set()
        for g in grams:
            for i in range(len(w) - len(g) + 1):
                if [x.group() for x in w[i:i + len(g)]] == g:
                    hit.update(range(i, i + len(g)))
        want, at = "", 0
        for i, x in enumerate(w):
            want += t[at:x.start()] + ("" if i in hit else x.group())
            at = x.end()
        assert got[d] == want + t[at:]


def test_work_is_linear_in_a_texts_length(spark):
    import time
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")

    def spent(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).cache()
        df.count()
        t0 = time.perf_counter()
        rows = dc.contamination(df, items).collect()
        kept = dc.drop_contaminated(df, items).count()
        took = time.perf_counter() - t0
        df.unpersist()
        assert sum(r.n_words for r in rows) >= 1_000_000 and kept == 0
        return took

    text = "w%d and some words more " * 20_000 % tuple(range(20_000)) + ITEM
    spent([text] * 10)
    assert spent([" ".join([text] * 10)]) < 3 * spent([text] * 10)
