"""The search index against plain Python and the unindexed search."""

import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickflow.operators.search import doc_search
from clickflow.operators.search_index import SearchIndex, _block_postings
from clickflow.plans.tables import Tables
from conftest import SF_SMALL, rows

WORDS = ["red", "Blue", "green's", "x-ray", "42", "été"]
SCHEMA = "doc_id long, lang string, n_chars int, text string, extra string"


def documents(n=120):
    r = random.Random(9)
    out = []
    for i in range(n):
        t = " ".join(r.choice(WORDS) for _ in range(r.randrange(0, 30)))
        out.append((i, r.choice(["en", "de", None]), len(t), t, "e"))
    return [*out, (n, "en", 0, None, "e"), (n + 1, "en", 0, "", "e")]


def tokens(t):
    return [x for x in re.split(r"[^A-Za-z0-9_]+", (t or "").lower()) if x]


def brute(docs, must, lang=None):
    toks = {d[0]: tokens(d[3]) for d in docs}
    n, mean = len(docs), sum(map(len, toks.values())) / len(docs)
    out = {}
    for i, l, *_ in docs:
        if all(w in toks[i] for w in must) and (lang is None or l == lang):
            score = 0.0
            for w in must:
                df, tf = sum(w in t for t in toks.values()), toks[i].count(w)
                score += math.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (
                    tf + 1.2 * (.25 + .75 * len(toks[i]) / mean))
            out[i] = (sum(toks[i].count(w) for w in must), round(score, 6))
    return out


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = documents()
    ix = SearchIndex(spark, str(tmp_path_factory.mktemp("index")), spark.createDataFrame(docs, SCHEMA).schema,
                     ["lang", "n_chars"], shards=8, block_docs=8)
    for n in range(3):
        part = spark.createDataFrame(docs[n * 41:(n + 1) * 41], SCHEMA)
        ix.add(part, n)
        ix.add(part, n)       # a replay
    ix.add(spark.createDataFrame([], SCHEMA), 3)
    return ix


@pytest.mark.parametrize("must,lang", [(["red"], None), (["RED", "blue"], "en"), (["x", "ray", "42"], None),
                                       (["nowhere"], None), (["red", "nowhere"], "en")])
def test_matches_and_scores(index, must, lang):
    got = {r.doc_id: (r.hits, round(r.score, 6)) for r in index.matching(
        must, {"lang": lang} if lang else None).collect()}
    assert got == brute(documents(), [w.lower() for w in must], lang)


def test_pages_read_their_own_texts(spark, index):
    want = sorted(brute(documents(), ["red"]).items(), key=lambda x: (-x[1][1], x[0]))
    page = index.search(["red"], size=5, offset=3)
    got = page.orderBy("rank").collect()
    assert [(r.doc_id, r["rank"]) for r in got] == [(d, i) for i, (d, _) in enumerate(want[3:8], 4)]
    assert all("<em>red</em>" in r.highlight for r in got)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan
    blocks = {f.split("/block=")[1].split("/")[0] for f in page.inputFiles()}
    want_blocks = {str(r.block) for r in index.matching(["red"]).where(
        F.col("doc_id").isin([r.doc_id for r in got])).collect()}
    assert blocks == want_blocks and len(blocks) < len(index.texts.read().inputFiles())
    assert index.search(["nowhere"]).count() == 0
    # postings alone decide, no text is read
    assert "text" not in index.matching(["red"])._jdf.queryExecution().executedPlan().toString().lower() \
        .replace("/texts", "").split("readschema")[-1]


def test_page_equals_the_unindexed_search(spark, tmp_path):
    docs = Tables(spark, SF_SMALL).raw("documents")
    ix = SearchIndex(spark, str(tmp_path), docs.schema, ["lang", "n_chars"], shards=4)
    ix.add(docs, 0)
    ix.postings.compact()
    got = ix.search(["that"], {"lang": "en"}, order_by=[F.desc("n_chars"), F.asc("doc_id")])
    want = doc_search(docs, "that", {"lang": "en"})
    cols = ["doc_id", "lang", "n_chars", "hits", "highlight"]
    assert rows(got, cols) == rows(want, cols)


def postings_plan(spark, tmp_path, monkeypatch):
    ix = SearchIndex(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ["lang", "n_chars"])
    plans, append = [], ix.postings.append
    monkeypatch.setattr(ix.postings, "append", lambda df, n: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), append(df, n)))
    ix.add(spark.createDataFrame(documents(), SCHEMA), 0)
    return plans[0]


def test_postings_shuffle_texts_alone(spark, tmp_path, monkeypatch):
    plan = postings_plan(spark, tmp_path, monkeypatch)
    assert plan.count("Exchange ") == 1
    below = plan.split("Exchange ")[1]
    assert "explode(" not in below and "inline(" not in below and "text#" in below


def test_no_row_per_document_and_token(spark, tmp_path, monkeypatch):
    plan = postings_plan(spark, tmp_path, monkeypatch)
    assert "Generate " not in plan and "collect_list(struct(" not in plan


def test_block_postings():
    docs = pa.table({"block": [7, 7, 7], "doc_id": [9, None, 2], "length": [3, 1, 4], "lang": ["en", None, "de"],
                     "words": [[["b", "a", "b"]], [["a"]], [["c", "b"], ["b", "b", "x", "c"]]]})
    got = {r["token"]: (r["block"], [tuple(e.values()) for e in r["entries"]])
           for r in _block_postings(docs).to_pylist()}
    assert got == {"a": (7, [(9, [1], 3, "en"), (None, [0], 1, None)]),
                   "b": (7, [(2, [0, 1, 1], 4, "de"), (9, [0, 2], 3, "en")]),
                   "c": (7, [(2, [0, 3], 4, "de")]), "x": (7, [(2, [2], 4, "de")])}


def test_rows_of_one_key_share_an_entry(spark, tmp_path):
    ix = SearchIndex(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ["lang", "n_chars"])
    ix.add(spark.createDataFrame([(1, "en", 9, "red blue", "e"), (1, "en", 9, "x red", "e"), (1, "de", 9, "red x", "e"),
                                  (None, None, None, "red red x", "e")], SCHEMA), 0)
    got = {(r.doc_id, r.lang, r.length): r.positions for r in ix.entries(["red"]).collect()}
    assert got == {(1, "en", 2): [0, 1], (1, "de", 2): [0], (None, None, 3): [0, 1]}
