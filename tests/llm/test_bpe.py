"""Distinct-word encoding against the tokenizers library."""

import random
from hashlib import sha256

import pyarrow as pa
import pytest

from clickflow.llm import bpe, queries


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path())


ODD = "İΣΑΣ<|endoftext|>'s'Sé́ﬁ​z　q\x1cw\x85r Ab1\n²½ªº×÷ßÿÀ’!?#\t-中文😀"


def texts():
    r = random.Random(4)
    out = ["".join(r.choice(ODD) for _ in range(r.randrange(80))) for _ in range(300)]
    out += ["".join(r.choice("abAB'sSt 19!.,ÉéÿßÑ\n") for _ in range(r.randrange(80))) for _ in range(300)]
    return [*out, None, "", "  \n", "　", "a<|endoftext|>b <|startoftext|> <|endoftext|>", "x" * 5000, "́a ́",
            "the cat " * 20_000]


def test_encode_and_decode_equal_the_library(spark, tok):
    docs = list(enumerate(texts())) + [(3, "again"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, ids string, code int")
    got = [(r.doc_id, list(r.ids), r.decoded) for r in
           bpe.encode(df.repartition(3), queries.tokenizer_path(), block_bytes=2000).collect()]
    want = []
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((d, ids, tok.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_blocks_are_bounded_and_hold_words_once(spark):
    docs = [(i, f"w{i % 7} the end {i}") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    texts = bpe.block_texts(df, block_bytes=1000, parts=8).collect()
    sizes = [len(r.doc_ids) for r in texts]
    assert sum(sizes) == 500 and len(sizes) > 5 and max(sizes) <= -(-1000 // 12)
    rows = bpe.block_words(df, block_bytes=1000, parts=8).collect()
    words = [w for r in rows for w in pa.decompress(
        r.words, r["size"], codec="zstd", asbytes=True).decode().split("\n")]
    assert words.count("the") == len(sizes)
    assert len({r.part for r in rows}) == 8 and {r.block for r in rows} == {r.block for r in texts}
    # "the" and "end" are the frequent words of a block
    assert all((bpe.unpack(r.codes) < 2).sum() == 2 * len(r.doc_ids) for r in texts)


def test_numbers_survive_packing():
    import numpy as np
    for x in ([], [0], [1, 2 ** 32 - 1, 77], list(range(70_000))):
        assert bpe.unpack(bpe.pack(np.array(x, dtype=np.int64))).tolist() == x


def test_forgetting_changes_nothing(spark, tok):
    docs = [(i, f"alpha{i % 11} beta gamma{i % 5}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: list(r.ids) for r in bpe.encode(
        df, queries.tokenizer_path(), block_bytes=300, parts=2, remembered=3).collect()}
    assert got == {i: tok.encode(t, add_special_tokens=False).ids for i, t in docs}


def test_query_digests(spark, tok, tmp_path):
    docs = [(1, "Hello, world! It's 2024"), (2, None), (3, "<|endoftext|>")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_word_bpe(spark, str(tmp_path)).collect())
    want = []
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want


def test_decode_of_given_ids(spark, tok):
    ids = [[320, 49407, 5], [], [999999]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "k int, ids array<int>")
    pieces = bpe.id_to_piece(spark, queries.tokenizer_path())
    got = {r.k: r.decoded for r in bpe.decode_ids(df, pieces, "k").collect()}
    assert got == {0: tok.decode(ids[0], skip_special_tokens=False), 1: "", 2: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert bpe.encode(df, queries.tokenizer_path(), replayable=True).count() == 0
    out = bpe.encode(df, queries.tokenizer_path())
    assert out.count() == 0 and dict(out.dtypes)["doc_id"] == "string"


def test_documents_that_change_are_an_error(spark):
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def other(x):
        import uuid
        return x.map(lambda t: " ".join(uuid.uuid4().hex for _ in range(uuid.uuid4().int % 9)))

    df = spark.range(20).select(F.col("id").alias("doc_id"), other(F.lit("x")).alias("text"))
    with pytest.raises(Exception, match="differently"):
        bpe.encode(df, queries.tokenizer_path(), replayable=True).collect()
    assert bpe.encode(df, queries.tokenizer_path()).count() == 20
