"""Periodic runs against a direct search over all periods."""

import random
import zlib
from hashlib import sha256

import pytest

from clickflow.llm import queries, runs


def brute(words, min_length=24, min_periods=3):
    """Every longest stretch of every period that is the stretch's smallest."""
    n, out = len(words), []
    for p in range(1, n // min_periods + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            lo = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - lo
            if length >= max(min_length, min_periods * p):
                part = words[lo:lo + length]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.append((lo, length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def report(doc_id, text):
    """The contract of op12, written out."""
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w))]
    found = brute(w)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def periodic(r, letters):
    out = []
    while len(out) < r.randrange(200):
        root = [r.choice(letters) for _ in range(r.randrange(1, 9))]
        out += (root * r.randrange(1, 12))[:r.randrange(1, 80)]
    return out


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghij"])
def test_runs_equal_brute_force(letters):
    r = random.Random(len(letters))
    for _ in range(300):
        w = periodic(r, letters)
        numbers = [ord(c) - 96 for c in w]
        assert runs.runs_of(numbers) == brute(w)
        assert runs.runs_of(numbers, 4, 2) == brute(w, 4, 2)
        words = [c.encode() for c in w]
        assert runs.word_runs(words) == brute(words)
        assert runs.word_runs(words, 5, 2) == brute(words, 5, 2)


def test_common_extensions():
    r = random.Random(5)
    for n in (30, 200, 3000):
        text = [r.choice([1, 1, 1, 2]) for _ in range(n)]
        ext = runs.Extensions(*runs.Tree(text).tour())
        i = [r.randrange(n + 1) for _ in range(500)]
        j = [r.randrange(n + 1) for _ in range(500)]
        pairs = [(a, b) for a, b in zip(i, j) if a != b]
        import numpy as np
        got = ext.of(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        for (a, b), k in zip(pairs, got):
            want = next((t for t in range(n - max(a, b)) if text[a + t] != text[b + t]), n - max(a, b))
            assert k == want


def test_best_run_is_exact():
    # 10^17 + 1 periods of 1 against 10^17: equal as floats
    big = 10 ** 17
    assert runs.best_run([(0, big, 1), (5, big + 1, 1), (9, 2 * big + 2, 2)]) == (5, big + 1, 1)


def test_query_equals_contract(spark, tmp_path):
    r = random.Random(11)
    docs = [(i, " ".join(periodic(r, "abc"))) for i in range(400)]
    docs += [(500, None), (501, ""), (None, "x " * 40), (None, None), (7, "y\t" * 30), (7, "y\t" * 30),
             (502, "one two three"), (503, "  \n "), (504, "Ünï　cödé " * 20), (505, "a\x1cb c " * 30)]
    # an id whose text repeats, with no words
    empty = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs += [(empty, " \n"), (empty, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(x) for x in queries.op12_suffix_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((report(*d) for d in docs), key=repr)


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([("k1", "b a " * 20, 1, "z")], "doc_id string, text string, runs int, best string")
    row = runs.periodic_runs(df).first()
    assert row.doc_id == "k1" and [tuple(x) for x in row.runs] == [(0, 40, 2)] and row.text == "b a"
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_long_text_is_linear():
    import time
    spent = []
    for n in (20_000, 200_000):
        text = [i % 7 + 1 for i in range(n // 2)] + [i % 1001 + 1 for i in range(n // 2)]
        t0 = time.perf_counter()
        found = runs.word_runs([str(x).encode() for x in text])
        spent.append(time.perf_counter() - t0)
        assert (n // 2 - n // 2 % 7, 7) or found
    assert spent[1] < 25 * spent[0]
