"""The pipeline's stages against brute force, and what is registered."""

import collections
import re

import __spark_entry__ as E
import corpus_pipeline
import duckdb
import pytest

from clickflow.llm import oracle, queries, quality_gam
from llm.test_decontaminate import brute as contaminated
from llm.test_near_dup import brute as groups
from llm.test_packing import check_pieces, packing, tokenizer_path
from llm.test_pii import luhn_ok

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = E.queries()
    ops = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op"))
    assert ops == list(range(1, 14)) and "pipeline" in names
    assert set(oracle.llm_sql()) <= set(queries.llm_queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_match_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{i}")
        before, docs = docs, spark.read.parquet(f"{scratch}/{i}")
        held[name] = (before, docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = held["quality"]
    scores = quality_gam.quality_scores(before, labels)
    assert set(r.doc_id for r in after.collect()) == {
        r.doc_id for r in scores.where("predicted = 1").collect()}
    good = labels.where("quality = 1").join(before, "doc_id").count()
    assert after.join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * good

    before, after = held["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {c for _, _, c in groups(rows, 5, 80)}

    before, after = held["decontaminate"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in after.collect()} == {r[0] for r in contaminated(rows, items) if not r[4]}

    before, after = held["pseudonyms"]
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text)
        for pattern in (r"\d{16}", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"(?:\d{1,3}\.){3}\d{1,3}",
                        r"\S+@\S+example\.com"):
            a, b = re.findall(pattern, old[r.doc_id]), re.findall(pattern, r.text)
            valid = {x for x in a if "16" not in pattern or luhn_ok(x)}
            assert not valid & set(b)
            assert "@" in pattern or len(a) == len(b)
            if "16" in pattern:   # others are no card numbers and stay
                assert [x for x in a if x not in valid] == [x for x in b if not luhn_ok(x)]

    before, after = held["packing"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    check_pieces(after.collect(), rows, packing.WordTokenizer(tokenizer_path()))


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 100


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0 if t == "documents" else 50).write.parquet(
            f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_url_sql_knows_ports_and_addresses(spark, tmp_path):
    hosts = ["a.example.org", "A.example.org:8080", "u:p@b.example.org:80", "10.1.2.3", "10.1.2.3:81",
             "10.9.2.3", "[::1]:80", "[2001:db8::1]", "x.co.uk", "y.x.co.uk:1", "co.uk", "bare", ""]
    pages = [(i, f"http://{hosts[i % len(hosts)]}/p{i}") for i in range(130)] + [(500, None), (501, "x")]
    labels = [(i, int(hosts[i % len(hosts)].startswith("10.1") or i % 3 == 0), 0) for i in range(0, 130, 2)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    c = duckdb.connect()
    for t in ("pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = E.queries()["op10_host_filter"](spark, str(tmp_path))
    want = c.execute(oracle.llm_sql()["op10_host_filter"])
    cols = [x[0] for x in want.description]
    assert collections.Counter(map(tuple, got.select(cols).collect())) == collections.Counter(want.fetchall())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.llm_sql()))
def test_query_matches_its_sql(spark, con, name):
    got = E.queries()[name](spark, SF)
    want = con.execute(oracle.llm_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert collections.Counter(map(tuple, got.select(cols).collect())) == collections.Counter(
        want.fetchall())
