"""Packing: every id in exactly one piece, no gaps, hardly any padding."""

import collections
import random
import zlib

import numpy as np
import pytest

from clickflow.llm import packing
from clickflow.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tok():
    return packing.WordTokenizer(tokenizer_path())


def plain_ids(tok, text):
    return tok.tok.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_ids_equal_the_tokenizers():
    r = random.Random(3)
    odd = "İΣΑΣ<|endoftext|>'s'Sé́ﬁ​z　q\x1cw\x85r Ab1\n²½ªº×÷ßÿÀ’!?#\t-中文😀"
    texts = ["".join(r.choice(odd) for _ in range(r.randrange(60))) for _ in range(800)]
    texts += ["".join(r.choice("abAB'sSt 19!.,ÉéÿßÑ\n") for _ in range(r.randrange(60)))
              for _ in range(800)]
    tok = packing.WordTokenizer(tokenizer_path(), remembered=500)
    for lo in range(0, len(texts), 40):
        for t, ids in zip(texts[lo:lo + 40], tok.encode(texts[lo:lo + 40])):
            assert ids.tolist() == plain_ids(tok, t)[:-1]
    assert tok.encode([]) == []


def check_pieces(rows, docs, tok):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    want = collections.Counter()
    for d, t in docs:
        want[d] += len(plain_ids(tok, t))
    assert {d: sum(r.length for r in v) for d, v in by_doc.items()} == dict(want)
    padding = 0
    for v in by_seq.values():
        v.sort(key=lambda r: r.offset)
        at = 0
        for r in v:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048 and {r.tier for r in v} == {v[0].tier} and at <= v[0].tier
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return by_doc, padding


def test_pieces_cover_documents(spark, tok):
    r = random.Random(1)
    docs = [(i, " ".join(f"w{r.randrange(999)}" for _ in range(r.choice([0, 1, 5, 90, 400, 3000]))))
            for i in range(300)] + [(1000, None), (1001, ""), (1002, "long word " * 30_000)]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, offset int")
    df = df.repartition(3).cache()
    rows = packing.pack_documents(df, tokenizer_path(), with_ids=True).collect()
    by_doc, padding = check_pieces(rows, docs, tok)
    for d, t in docs:
        pieces = sorted(by_doc[d], key=lambda x: x.start)
        ids = [i for p in pieces for i in p.ids]
        assert ids == plain_ids(tok, t)
        assert [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
    assert padding <= 3 * 2048
    groups = collections.defaultdict(set)
    for p in rows:
        groups[p.step_group].add((p.sequence_id, p.tier))
    assert all(sum(t for _, t in g) <= packing.STEP_TOKENS for g in groups.values())


def test_step_groups_are_full_over_many_partitions(spark):
    r = random.Random(2)
    docs = [(i, " ".join(f"w{r.randrange(99)}" for _ in range(r.choice([5, 90, 400, 3000]))))
            for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(50)
    groups = collections.defaultdict(set)
    for p in packing.pack_documents(df, tokenizer_path()).collect():
        groups[p.tier, p.step_group].add(p.sequence_id)
    assert len({g for _, g in groups}) == len(groups)
    for tier in packing.TIERS:
        held = sorted(len(v) * tier for (t, _), v in groups.items() if t == tier)
        assert all(h == packing.STEP_TOKENS for h in held[1:]) and held[0] <= packing.STEP_TOKENS
    assert sum(t == 2048 for t, _ in groups) > 2


def test_null_and_repeated_ids_and_empty_table(spark, tok):
    docs = [(None, "a b c"), (7, "x " * 5000), (7, "x " * 5000), (8, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    check_pieces(packing.pack_documents(df, tokenizer_path()).collect(), docs, tok)
    assert packing.pack_documents(df.limit(0), tokenizer_path()).count() == 0


def test_blocks_are_bounded():
    p, out = packing.Packer(), []
    r = np.random.default_rng(0)
    for i in range(3000):
        out += p.add(i, np.zeros(r.integers(1, 5000), dtype=np.uint32))
        if p.tokens >= 20_000:
            out += p.flush()
            assert p.tokens < 2048
    out += p.finish()
    assert not p.pool
    full = [sum(len(x.ids) for x in w) == t for t, w in out]
    assert full.count(False) <= 1 and {t for t, _ in out} == set(packing.TIERS)
